"""Toxicity by Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is learned from labelled rows: words, and stems shared by several words, that
occur far more often in toxic texts. The automaton that accepts every string within one
edit of a lexicon word, or that begins within one edit of a stem, is intersected with the trie of the lexicon: a state is a set of
(trie node, edits so far), made when a text first needs it; most words die after two or
three characters. A hit's weight is the log ratio of its rates, per word of text, in toxic and in other texts; a window of words
tells quotation (quote marks, reporting words) from abuse (address). Hits of terms that clean texts use now and then count only as far as
they go beyond what a toxic text of that length would have (a Poisson model), so that a stray one in a long text isn't abuse.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import bounded, discard, written
from .ragged import kept

_WORD = re.compile(r"[^\W_]+")
#: Marks that open or close a quotation, words that report speech, and words of address.
QUOTES = frozenset('"“”„«»')
REPORTING = frozenset("said says called wrote word term quote quoted sagte schrieb wort zitat dit écrit mot citation dijo escribió palabra cita".split())
ADDRESS = frozenset("you your yours du dich dein ihr euch tu te ton vous votre tú ti usted ustedes vosotros".split())
MAX_REMEMBERED = 200_000
#: Misspelled forms are looked for of words and stems of so many letters or more; a shorter one has too many neighbours.
FUZZY_FROM = 5


class FuzzyLexicon:
    """Words within ``edits`` of a lexicon word, and words that begin within ``edits`` of a stem."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], fuzzy_from: int = FUZZY_FROM, edits: int = 1) -> None:
        self.words, self.stems, self.edits = words, stems, edits
        self.stem_lengths = sorted({len(s) for s in stems})
        self.children: list[dict[str, int]] = [{}]
        self.word_at: dict[int, str] = {}
        self.stem_at: dict[int, str] = {}
        for terms, at in ((words, self.word_at), (stems, self.stem_at)):
            for term in terms:
                if len(term) >= fuzzy_from:
                    node = 0
                    for c in term:
                        if c not in self.children[node]:
                            self.children[node][c] = len(self.children)
                            self.children.append({})
                        node = self.children[node][c]
                    at[node] = term
        self.start = self._closed({(0, 0)})
        self.moves: dict[tuple[frozenset, str], frozenset] = {}

    def _closed(self, state: set[tuple[int, int]]) -> frozenset:
        """With the nodes reached by leaving out characters of the lexicon word."""
        out, todo = set(), list(state)
        while todo:
            node, used = todo.pop()
            if (node, used) in out:
                continue
            out.add((node, used))
            if used < self.edits:
                todo += [(child, used + 1) for child in self.children[node].values()]
        return frozenset(out)

    def _move(self, state: frozenset, c: str) -> frozenset:
        to = set()
        for node, used in state:
            for x, child in self.children[node].items():
                if x == c or used < self.edits:
                    to.add((child, used + (x != c)))
            if used < self.edits:
                to.add((node, used + 1))
        return self._closed(to)

    def near(self, word: str) -> tuple[str, int] | None:
        """The nearest lexicon word within reach (of equals the first by spelling), and the edits."""
        return self._walk(word)[0]

    def near_stem(self, word: str) -> tuple[str, int] | None:
        """The nearest stem that the word begins with, within reach."""
        return self._walk(word)[1]

    def _walk(self, word: str) -> tuple[tuple[str, int] | None, tuple[str, int] | None]:
        state, stem = self.start, None
        for c in word:
            to = self.moves.get((state, c))
            if to is None:
                if len(self.moves) > MAX_REMEMBERED:
                    self.moves.clear()
                to = self.moves[state, c] = self._move(state, c)
            if not to:
                return None, stem
            state = to
            if self.stem_at:
                met = [(used, self.stem_at[node]) for node, used in state if node in self.stem_at]
                if met and (stem is None or min(met) < stem[::-1]):
                    stem = min(met)[::-1]
        found = [(used, self.word_at[node]) for node, used in state if node in self.word_at]
        return (min(found)[::-1] if found else None), stem

    def stem(self, word: str) -> str | None:
        return next((word[:n] for n in self.stem_lengths if word[:n] in self.stems), None)


@dataclass
class ToxicityModel:
    prior: float = -2.0
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    #: Weights of forms that begin within an edit of a stem; of stems whose such forms tell nothing there is none.
    loose_stems: dict[str, float] = field(default_factory=dict)
    #: Misspelled forms that clean texts use as words of their own.
    innocent: frozenset[str] = frozenset()
    #: Terms that clean texts use too, and how many more lexicon terms a toxic text has than others, in each word of text.
    stray: frozenset[str] = frozenset()
    expected: float = 0.0

    def __post_init__(self) -> None:
        self.lexicon = FuzzyLexicon(self.words, self.stems)
        self.weights: dict[str, tuple[float, bool]] = {}

    def weight(self, word: str) -> tuple[float, bool]:
        """Log-likelihood ratio of a word, 0 for most, and whether it may be a stray use. A misspelled form counts a little less than the word."""
        w = self.weights.get(word)
        if w is None:
            if len(self.weights) > MAX_REMEMBERED:
                self.weights.clear()
            w = self.weights[word] = self._weight(word)
        return w

    def _weight(self, word: str) -> tuple[float, bool]:
        if word in self.words:
            return self.words[word], word in self.stray
        if stem := self.lexicon.stem(word):
            return self.stems[stem], stem in self.stray
        if word in self.innocent:
            return 0.0, False
        near, stem = self.lexicon._walk(word)
        if near:
            return 0.7 * self.words[near[0]], near[0] in self.stray
        return (self.loose_stems.get(stem[0], 0.0), True) if stem else (0.0, False)

    def score(self, text: str | None, window: int = 8) -> tuple[float, int]:
        """Probability of the label, and hits taken as abuse. Whole texts; an empty one gets the prior."""
        text = (text or "").lower()
        words = _WORD.findall(text)
        hits = [i for i, w in enumerate(words) if self.weight(w)[0]] if self.words or self.stems else []
        abuse = quoted = strays = 0.0
        n = 0
        places = [m.span() for m in _WORD.finditer(text)] if hits else []
        for i in hits:
            low, high = max(0, i - window), min(len(words), i + 1 + window)
            # what stands between the words of the window counts, and what follows the word before it
            before = text[places[low - 1][1] if low else 0 : places[i][0]]
            after = text[places[i][1] : places[high][0] if high < len(words) else len(text)]
            line_before, line_after = before.rpartition("\n")[2], after.partition("\n")[0]
            cited = any(c in QUOTES for c in line_before) and any(c in QUOTES for c in line_after)
            cited = cited or bool(REPORTING.intersection(_WORD.findall(line_before)[-3:]))
            weight, stray = self.weight(words[i])
            if cited and not ADDRESS.intersection(words[low:i] + words[i + 1 : high]):
                quoted += 0.2 * weight
            else:
                n += 1
                if stray:
                    strays += weight
                else:
                    abuse += weight
        logit = self.prior + abuse + max(0.0, strays - self.expected * len(words)) + min(quoted, max(0.0, -self.prior))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))), n


def training_rows(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of rows that may be learned from; of contradicting labels of a document the larger counts."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold("doc_id") != 1)
    return known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def fold(id_col: str):
    """0 to 2 by the id's crc32; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3


def learn(
    documents: DataFrame,
    labels: DataFrame,
    *,
    max_rows: int = 20_000,
    least_ratio: float = 3.0,
    least_evidence: float = 13.0,
) -> ToxicityModel:
    """A model from at most ``max_rows`` labelled documents (those of least hash of the id), training fold only.

    A word or stem counts if the log ratio of its rates is ``least_ratio`` or more, the G statistic of the texts that hold it
    ``least_evidence`` or more, and its uses have nearly as many different neighbours as there are
    texts, so that copies of one text don't make its rare words look telling. All accepted
    terms come to the driver, and the words of clean texts an edit away from them: no more than the words of ``max_rows`` texts.
    Without toxic labels the lexicon is empty.
    """
    spark = documents.sparkSession
    sample = training_rows(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # at most max_rows pairs of numbers
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "toxic")

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, times, toxic, around = [], [], [], []
            for text, label in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
                found = _WORD.findall((text.as_py() or "").lower())
                first = {w: i for i, w in reversed(list(enumerate(found)))}
                counts = Counter(found)
                words += first
                times += [counts[w] for w in first]
                around += [xxhash.xxh3_64_intdigest(" ".join(found[max(0, i - 2) : i] + found[i + 1 : i + 3])) >> 1 for i in first.values()]
                # the empty word counts the texts themselves, and all their words
                words.append("")
                times.append(len(found))
                around.append(0)
                toxic += [label] * (len(first) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(times, pa.int64()), pa.array(toxic, pa.int32()), pa.array(around, pa.int64())], names=["word", "times", "toxic", "around"])

    uses = rows.mapInArrow(bounded(tell), "word string, times bigint, toxic int, around bigint")
    clean = 1 - F.col("toxic")
    stats = uses.groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(clean).alias("good"), F.sum(F.col("toxic") * F.col("times")).alias("bad_uses"), F.sum(clean * F.col("times")).alias("good_uses"),
        F.approx_count_distinct(F.when(F.col("toxic") == 1, F.col("around"))).alias("kinds"),
    )
    stats = written(stats, "words")
    texts = stats.where("word = ''").first()
    bad, good = (texts["bad"], texts["good"]) if texts else (0, 0)
    prior = math.log((bad + 0.5) / (good + 0.5))
    if not bad or not good:
        discard(stats)
        return ToxicityModel(min(prior, -1.0))
    bad_words, good_words = texts["bad_uses"] + 1, texts["good_uses"] + 1
    ratio = F.log((F.col("bad_uses") + 0.5) / bad_words) - F.log((F.col("good_uses") + 0.5) / good_words)
    both = F.col("bad") + F.col("good")
    share = bad / (bad + good)
    g = F.col("bad") * F.log(F.col("bad") / (both * share)) + F.when(F.col("good") > 0, F.col("good") * F.log(F.col("good") / (both * (1 - share)))).otherwise(0.0)
    surplus = F.col("bad_uses") / bad_words - F.col("good_uses") / good_words

    def accepted(df: DataFrame, evidence: float) -> list:
        told = df.where("bad > 0").withColumn("ratio", ratio).where((F.col("ratio") >= least_ratio) & (g >= evidence) & (F.col("kinds") >= 0.7 * F.col("bad")))
        # of the texts that hold the term, more than one in fifty is clean
        stray = 50 * F.col("good") > both
        return told.select("word", "ratio", surplus.alias("surplus"), stray.alias("stray")).orderBy("word").collect()

    sums = [F.sum(c).alias(c) for c in ("bad", "good", "bad_uses", "good_uses", "kinds")]
    prefixes = stats.where("length(word) > 4").select(F.expr("explode(transform(sequence(4, least(8, length(word) - 1)), n -> substring(word, 1, n)))").alias("p"), "*")
    stems = prefixes.groupBy(F.col("p").alias("word")).agg(*sums, F.count_if(F.col("bad") > 0).alias("forms"), F.max("bad").alias("most"))
    # a stem has several forms, none of which makes up most of its uses
    stem_rows = accepted(stems.where("forms >= 4 AND most <= 0.5 * bad"), 1.5 * least_evidence)
    found_stems: dict[str, float] = {}
    stray: set[str] = set()
    expected = 0.0
    for r in sorted(stem_rows, key=lambda r: (len(r["word"]), r["word"])):
        if not any(r["word"].startswith(s) for s in found_stems):
            found_stems[r["word"]] = float(r["ratio"])
            expected += r["surplus"]
            if r["stray"]:
                stray.add(r["word"])
    words: dict[str, float] = {}
    for r in accepted(stats.where("length(word) > 1"), least_evidence):
        if not any(r["word"].startswith(s) for s in found_stems):
            words[r["word"]] = float(r["ratio"])
            expected += r["surplus"]
            if r["stray"]:
                stray.add(r["word"])
    lexicon = spark.sparkContext.broadcast(FuzzyLexicon(words, found_stems))

    def misspelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, stem = [], []
            for w in batch["word"].to_pylist():
                known = w in lexicon.value.words or lexicon.value.stem(w) is not None
                near, begins = (None, None) if known else lexicon.value._walk(w)
                term.append(near and near[0])
                stem.append(begins and not near and begins[0] or None)
            out = batch.append_column("term", pa.array(term, pa.string())).append_column("stem", pa.array(stem, pa.string()))
            yield out.filter(pa.array([t is not None or s is not None for t, s in zip(term, stem, strict=True)], pa.bool_()))

    loose = stats.where("word <> ''").select("word", "bad", "good", "bad_uses", "good_uses", "kinds").mapInArrow(bounded(misspelled), "word string, bad bigint, good bigint, bad_uses bigint, good_uses bigint, kinds bigint, term string, stem string")
    loose = written(loose, "misspelled")
    innocent = loose.where("term IS NOT NULL AND good > 0").withColumn("ratio", ratio).where(F.col("ratio") < least_ratio).select("word").collect()
    # a stem's misspelled forms count together, if they tell anything
    of_stems = accepted(loose.where("stem IS NOT NULL").groupBy(F.col("stem").alias("word")).agg(*sums), least_evidence)
    model = ToxicityModel(prior, words, found_stems, {r["word"]: float(r["ratio"]) for r in of_stems}, frozenset(r["word"] for r in innocent), frozenset(stray), expected)
    discard(stats)
    discard(loose)
    return model


def score_texts(df: DataFrame, model: ToxicityModel, *, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``keep`` of every row, ``score`` (0 to 1) and ``n_abuse`` (hits taken as abuse). One scan, no shuffle.

    Null texts count as empty and get the prior. The model (bounded by its number of terms) is broadcast.
    """
    spark = df.sparkSession
    values = (model.prior, model.words, model.stems, model.loose_stems, model.innocent, model.stray, model.expected)
    key = hashlib.sha256(repr([*values[:4], sorted(model.innocent), sorted(model.stray), model.expected]).encode()).hexdigest()
    parts = spark.sparkContext.broadcast(values)
    fields = {f.name: f.dataType.simpleString() for f in df.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = kept("toxicity", key, lambda: ToxicityModel(*parts.value))
        for batch in batches:
            found = [mine.score(t.as_py()) for t in batch[text_at]]
            columns = [*[batch[f"_keep_{c}"] for c in keep], pa.array([s for s, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "n_abuse"])

    schema = "".join(f"`{c}` {fields[c]}, " for c in keep) + "score double, n_abuse bigint"
    text_at = f"_keep_{text_col}" if text_col in keep else "_text"
    extra = [] if text_col in keep else [F.col(text_col).alias("_text")]
    return df.select(*extra, *[F.col(c).alias(f"_keep_{c}") for c in keep]).mapInArrow(bounded(run), schema)


def op9(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row for each of ``documents``; a row with a null id is scored too and isn't held out."""
    scored = score_texts(documents, learn(documents, labels), keep=("doc_id",))
    return scored.select("doc_id", F.coalesce(fold("doc_id") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
