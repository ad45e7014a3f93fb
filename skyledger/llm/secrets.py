"""Secret scans: patterns with fixed meaning, and sliding-window entropy of other candidates.

Built-in functions only, one scan, no shuffle. Positions are counted in code points.
A candidate is a long run of token characters that no pattern has claimed. Over each
window of it the Shannon entropy is kept up by incremental counts: the entering
character's count goes up, the leaving one's down, and the sum of n log2 n changes by
those two terms alone. The largest entropy is held against the threshold of the
candidate's character class; an allow-list then drops known harmless forms.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def either_case(word: str) -> str:
    """A pattern for ``word`` with ASCII letters in either case (no other letter folds into it)."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


#: Kinds in the order in which spans with one start are listed: pattern, and a text that every match holds or a pattern for it.
ASSIGN = "({})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)".format("|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key"))))
BASE: list[tuple[str, str]] = [("assign", ASSIGN), ("access", "AKIA[A-Z0-9]+"), ("hex", "[0-9a-f]{24,}")]
KINDS = ["assign", "access", "hex", "entropy"]
#: So many characters of a key in a row are in every match of kind access or hex, and in every candidate of the default rule.
RUN = "[A-Za-z0-9+/_=-]{20}"
#: Beyond any place in a text.
LAST = 2**31 - 1


@dataclass(frozen=True)
class EntropyRule:
    """``classes``: (name, whole-candidate pattern, least entropy in bits or None for never), the first that fits counts.

    The levels are chosen by the share of evenly drawn random strings of 20, 32 and 40 characters (6000 of each) that stay below them and so
    are missed: ``mixed`` (62 characters) 4, 0.2 and 0 percent, ``hex`` (16) 4, 0.2 and 0, ``letters`` (52), where joined words come close, 49, 13
    and 5. ``digits`` are never reported: phone numbers, account numbers and times are as mixed as keys.
    """

    candidate: str = "[A-Za-z0-9+/_=-]{20,}"
    window: int = 20
    classes: tuple[tuple[str, str, float | None], ...] = (
        ("digits", "^[0-9+/_=-]+$", None),
        ("letters", "^[A-Za-z+/_=-]+$", 4.01),
        ("hex", "^[0-9a-fA-F]+$", 3.01),
        ("mixed", "", 3.76),
    )
    #: Candidates that hold one of these are let go: sample keys, UUIDs, dates and counters.
    allow: tuple[str, ...] = field(default=(either_case("example"), "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$", "^(19|20)[0-9][0-9]-[01][0-9]-[0-3][0-9]"))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


#: Running totals are made in portions of so many elements, so that their cost doesn't grow with the square of a text's matches.
PORTION = 128


def _before(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` (integers) what ``join`` makes of 0 and all those before it."""
    grow = lambda acc, x: F.concat(acc, F.array(join(F.element_at(acc, -1), x)))

    def totals(v: Column) -> Column:
        portion = lambda c: F.slice(v, c * PORTION + 1, F.lit(PORTION))
        portions = F.when(F.size(v) > 0, F.sequence(F.lit(0), F.floor((F.size(v) - 1) / PORTION).cast("int"))).otherwise(F.array().cast("array<int>"))
        starts = F.aggregate(F.transform(portions, lambda c: F.aggregate(portion(c), F.lit(0), join)), F.array(F.lit(0)), grow)
        return _let(starts, lambda s: F.flatten(F.transform(portions, lambda c: _let(F.aggregate(portion(c), F.array(F.get(s, c)), grow), lambda r: F.slice(r, 1, F.size(r) - 1)))))

    return _let(values, totals)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches as structs start, rank, kind, end, match; lengths of what lies between give the starts."""
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))

    def placed(steps: Column) -> Column:
        lengths = F.transform(steps, lambda x: F.length(x["p"]) + F.length(x["m"]))
        return _let(_before(lengths, lambda a, b: a + b), lambda before: F.transform(steps, lambda x, i: span(x, F.get(before, i) + F.length(x["p"]))))

    def span(x: Column, start: Column) -> Column:
        end = start + F.length(x["m"])
        return F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), x["m"].alias("match"))

    # the last piece follows the last match, and so has none
    return _let(F.filter(found, lambda x: x["m"].isNotNull()), placed)


def window_entropy(candidate: Column, window: int) -> Column:
    """Largest Shannon entropy, in bits, of any ``window`` characters of an ASCII string; 0 for a shorter one.

    The state is a string whose character at a code's place tells how often that
    character is in the window.
    """
    terms = F.array(*[F.lit(n * math.log2(n) if n else 0.0) for n in range(window + 1)])
    term = lambda n: F.element_at(terms, n + 1)
    start = F.struct(F.lit("0" * 128).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))

    def change(state: Column, char: Column, by: int) -> Column:
        place = F.ascii(char) + 1
        return _let(
            F.ascii(F.substring(state["counts"], place, F.lit(1))) - 48,
            lambda n: F.struct(
                F.overlay(state["counts"], F.char(n + 48 + by), place, F.lit(1)).alias("counts"),
                (state["sum"] - term(n) + term(n + by)).alias("sum"),
                state["best"].alias("best"),
            ),
        )

    def step(acc: Column, i: Column) -> Column:
        left = F.when(i > window, change(acc, F.substring(candidate, i - window, F.lit(1)), -1)).otherwise(acc)
        entered = _let(left, lambda s: change(s, F.substring(candidate, i, F.lit(1)), 1))
        entropy = lambda s: F.when(i >= window, F.lit(math.log2(window)) - s["sum"] / window).otherwise(0.0)
        return _let(entered, lambda s: F.struct(s["counts"].alias("counts"), s["sum"].alias("sum"), F.greatest(s["best"], entropy(s)).alias("best")))

    return F.aggregate(F.sequence(F.lit(1), F.length(candidate)), start, step, lambda acc: acc["best"])


def _holds(text: Column, run: Column, kind: str) -> Column:
    """A cheap test that every text with a match passes; ``run`` tells whether the text matches ``RUN``, as it does wherever a key of kind access or hex stands."""
    if kind == "access":
        return run & text.contains("AKIA")
    if kind == "hex":
        return run & text.rlike("[0-9a-f]{24}")
    # words without an i, whose lower case depends on the locale
    return _let(F.lower(text), lambda t: reduce(Column.__or__, [t.contains(word) for word in ("passw", "secret", "token", "key")]))


def _clear(base: Column, candidates: Column) -> Column:
    """Those of ``candidates`` that share no character with any of ``base``; both are spans sorted by start, and candidates don't overlap.

    In one order of both, the latest end of the base spans before a candidate and the least start of those after it decide, and
    both are running totals, so the work doesn't grow with the product of the two.
    """
    is_base, latest = (lambda x: x["kind"] != "entropy"), (lambda a, b: F.greatest(a, b))

    def among(every: Column) -> Column:
        ended = _before(F.transform(every, lambda x: F.when(is_base(x), x["end"]).otherwise(0)), latest)
        ahead = F.reverse(_before(F.transform(F.reverse(every), lambda x: F.when(is_base(x), F.lit(LAST) - x["start"]).otherwise(0)), latest))
        free = lambda x, i, e, a: ~is_base(x) & (F.get(e, i) <= x["start"]) & (F.lit(LAST) - F.get(a, i) >= x["end"])
        return _let(F.struct(ended.alias("e"), ahead.alias("a")), lambda t: F.filter(every, lambda x, i: free(x, i, t["e"], t["a"])))

    return F.when((F.size(base) > 0) & (F.size(candidates) > 0), _let(F.array_sort(F.concat(base, candidates)), among)).otherwise(candidates)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def find_secrets(df: DataFrame, text_col: str = "text", out: str = "secret_spans", entropy: EntropyRule = EntropyRule()) -> DataFrame:
    """``df`` with a column ``out``: all spans as structs (start, rank, kind, end), sorted by start, then kind.

    Base kinds keep every match: ``assign`` those of 6 characters and more after the sign, ``access``
    20 and more, ``hex`` 24 and more. Kind ``entropy`` adds candidates that overlap none of them.
    Null texts count as empty and have none. Texts are scanned whole, in time that grows with the text however many
    matches it has. All other columns are kept as they are, whatever their names; ``out`` takes the place of one of its name.
    """
    text, base, clear, run = F.coalesce(F.col(text_col), F.lit("")), *[free_name(df, c) for c in ("base", "clear", "run")]
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,match:string>>")
    keep = {
        "assign": lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6,
        "access": lambda m: F.length(m) >= 20,
        "hex": lambda m: F.lit(True),
    }
    of_match = lambda test: lambda x: test(x["match"])
    df = df.withColumn(run, text.rlike(RUN))
    found = [F.when(_holds(text, F.col(run), k), F.filter(_matches(text, p, k), of_match(keep[k]))).otherwise(none) for k, p in BASE]
    df = df.withColumn(base, F.array_sort(F.concat(*found)))

    def likely(x: Column) -> Column:
        # cheapest first; Spark leaves the rest of a conjunction undone when one part is false
        level = F.coalesce(*[F.when(x["match"].rlike(p) if p else F.lit(True), F.lit(math.inf if v is None else v)) for _, p, v in entropy.classes])
        allowed = F.lit(False)
        for pattern in entropy.allow:
            allowed = allowed | x["match"].rlike(pattern)
        return F.when(allowed | (level > math.log2(entropy.window)), False).otherwise(window_entropy(x["match"], entropy.window) >= level)

    may = F.col(run) if entropy.candidate == EntropyRule.candidate else text.rlike(entropy.candidate)
    candidates = F.when(may, _matches(text, entropy.candidate, "entropy")).otherwise(none)
    df = df.withColumn(clear, candidates)
    df = df.withColumn(clear, _clear(F.col(base), F.col(clear)))
    spans = F.transform(F.array_sort(F.concat(base, F.filter(clear, likely))), lambda x: x.dropFields("match"))
    return df.withColumn(out, spans).drop(base, clear, run)


def redact(df: DataFrame, spans_col: str = "secret_spans", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every span of the text replaced by ``mark``; spans that overlap share one. Null texts stay null."""
    text, spans = F.col(text_col), F.col(spans_col)
    ends = F.transform(spans, lambda x: x["end"])

    def pieces(before: Column) -> Column:
        # before a span the text up to it from where all earlier spans have ended; none if it begins within one of these.
        # Finding a place in a text takes time in its length, so each portion of the spans gets the part of the text that it needs
        def portion(c: Column) -> Column:
            some, first = F.slice(spans, c * PORTION + 1, F.lit(PORTION)), F.get(before, c * PORTION)
            part = F.substring(text, first + 1, F.greatest(F.array_max(F.transform(some, lambda x: x["start"])) - first, F.lit(0)))

            def piece(shown: Column) -> Column:
                one = lambda x, at: F.when(x["start"] >= at, F.concat(F.substring(shown, at - first + 1, x["start"] - at), F.lit(mark))).otherwise("")
                return F.transform(some, lambda x, i: _let(F.get(before, c * PORTION + i), lambda at: one(x, at)))

            return F.array_join(_let(part, piece), "")

        return F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / PORTION).cast("int")), portion), "")

    redacted = _let(_before(ends, lambda a, b: F.greatest(a, b)), lambda before: F.concat(pieces(before), F.substring(text, F.array_max(ends) + 1, F.length(text))))
    return df.withColumn(text_col, F.when(F.size(spans_col) > 0, redacted).otherwise(text))


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def op6(documents: DataFrame) -> DataFrame:
    rows = find_secrets(documents.select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secret_spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("secret_spans", lambda x: x["kind"] != "entropy")
    return rows.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(_shown(base).cast("binary"), 256).alias("base_sha256"), _shown(F.col("secret_spans")).alias("spans")
    )


def op6_sql(rule: EntropyRule = EntropyRule()) -> str:
    """The same rows in DuckDB's SQL; windows are counted anew, not incrementally."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def spans(name: str, kind: str, pattern: str, keep: str) -> str:
        p = quote(pattern)
        return f"""{name} AS (
  SELECT doc_id, list_filter(list_transform(range(1, len(m) + 1), lambda i: {{'start': coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
    'rank': {KINDS.index(kind)}, 'match': m[i]}}), lambda s: {keep}) AS s
  FROM (SELECT doc_id, regexp_extract_all(text, {p}) AS m, regexp_split_to_array(text, {p}) AS p FROM d WHERE regexp_matches(text, {p}))
)"""

    w = rule.window
    entropy = f"""list_max(list_transform(range(1, length(s.match) - {w - 2}), lambda k: {math.log2(w)!r} - list_sum(list_transform(range(33, 127), lambda c:
      CASE WHEN instr(substr(s.match, k, {w}), chr(CAST(c AS INTEGER))) = 0 THEN 0 ELSE (length(substr(s.match, k, {w})) - length(replace(substr(s.match, k, {w}), chr(CAST(c AS INTEGER)), '')))
      * log2(length(substr(s.match, k, {w})) - length(replace(substr(s.match, k, {w}), chr(CAST(c AS INTEGER)), ''))) END)) / {w}))"""
    level_of = lambda x: 99 if x is None else x  # noqa: E731 - beyond any window's entropy
    level = "CASE " + " ".join(f"WHEN regexp_matches(s.match, {quote(p)}) THEN {level_of(x)}" if p else f"ELSE {level_of(x)}" for _, p, x in rule.classes) + " END"
    allowed = " OR ".join(f"regexp_matches(s.match, {quote(p)})" for p in rule.allow)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{spans("a", "assign", ASSIGN, f"length(regexp_extract(s.match, {quote(ASSIGN)}, 2)) >= 6")},
{spans("k", "access", BASE[1][1], "length(s.match) >= 20")},
{spans("h", "hex", BASE[2][1], "true")},
{spans("c", "entropy", rule.candidate, f"NOT ({allowed})")},
b AS (SELECT d.doc_id, coalesce(a.s, []) AS a, coalesce(k.s, []) AS k, coalesce(h.s, []) AS h, coalesce(c.s, []) AS c
  FROM d LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN h USING (doc_id) LEFT JOIN c USING (doc_id)),
base AS (SELECT *, list_sort(list_concat(list_concat(a, k), h)) AS s0 FROM b),
free AS (SELECT *, list_filter(c, lambda s: len(list_filter(s0, lambda y: y.start < s.start + length(s.match) AND s.start < y.start + length(y.match))) = 0) AS c1 FROM base),
more AS (SELECT *, list_sort(list_concat(s0, list_filter(c1, lambda s: {entropy} >= {level}))) AS s1 FROM free),
shown AS (SELECT doc_id, len(a) AS n_assign, len(k) AS n_access, len(h) AS n_hex,
  array_to_string(list_transform(s0, lambda s: {KINDS!r}[s.rank + 1] || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + length(s.match) AS BIGINT)), ',') AS base,
  array_to_string(list_transform(s1, lambda s: {KINDS!r}[s.rank + 1] || ':' || CAST(s.start AS BIGINT) || ':' || CAST(s.start + length(s.match) AS BIGINT)), ',') AS spans FROM more)
SELECT doc_id, n_assign, n_access, n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM shown"""
