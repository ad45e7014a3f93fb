"""Packing, vector codes and infilling against brute force, round trips and odd input."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import ball_trees, best_fit, fill_middle

public_tokenizers = pytest.importorskip("public_tokenizers")
ODD = [None, "", "\n", "\n\n", "a", "a\nb", "no <S> here\nx", "é\nü\r\nz\n", "line\n" * 700, "x" * 9000, " \t\n y"]


# --- packing ---


def one_by_one(lengths, caps, rule):
    bins, out, offsets = [], [], []
    for n in lengths:
        demand, best = np.array([n, 1, n * n]), None
        for i, left in enumerate(bins):
            if (left >= demand).all():
                score = (((left - demand) / caps.limits) ** 2) @ caps.weights if rule == "norm" else (left / caps.limits * (demand / caps.limits)) @ caps.weights
                if best is None or score < best[0]:
                    best = score, i
        if best is None:
            bins.append(caps.limits.copy())
            best = 0, len(bins) - 1
        offsets.append(int(caps.limits[0] - bins[best[1]][0]))
        bins[best[1]] = bins[best[1]] - demand
        out.append(best[1])
    return out, offsets, [int(b[0]) for b in bins]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_is_that_of_one_piece_after_the_other(rule):
    rng = random.Random(1)
    for _ in range(120):
        cap = rng.choice([10, 20, 64])
        caps = best_fit.Capacities(cap, rng.choice([None, 2, 5]), rng.choice([None, cap * cap // 2, cap * cap // 4]), rng.choice([(1, 0, 0), (1, 0.5, 0.25)]))
        lengths = sorted((rng.randint(1, caps.piece) for _ in range(rng.randint(0, 80))), reverse=True)
        bins, offsets, room = best_fit.best_fit(np.array(lengths, np.int64), caps, rule)
        assert (bins.tolist(), offsets.tolist(), room.tolist()) == one_by_one(lengths, caps, rule)
    with pytest.raises(ValueError):
        best_fit.best_fit(np.array([11]), best_fit.Capacities(10), rule)


def characters():
    """A tokenizer of our own: one id for each character, then 0."""

    def by_characters():
        def encode(texts):
            return np.array([x for t in texts for x in [*map(ord, t), 0]], np.int64), np.array([len(t) + 1 for t in texts], np.int64)

        return encode

    return by_characters


@pytest.mark.parametrize("caps", [best_fit.Capacities(40), best_fit.Capacities(40, 3, 900)])
def test_packing_whole(spark, caps):
    rng = random.Random(2)
    texts = [*ODD, *["w" * rng.randint(0, 60) for _ in range(300)], *["same"] * 150]
    rows = [(None if t == "same" else i, t, "s", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id int, text string, sequence_id string, _item int")
    out = best_fit.pack_documents(df, characters(), caps, group=50, with_ids=True).cache()
    got = out.collect()
    want = {}
    for doc_id, text, *_ in rows:
        ids = [*map(ord, text or ""), 0]
        pieces = [(p, s, min(caps.piece, len(ids) - s), zlib.crc32(np.array(ids[s : s + caps.piece], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), caps.piece))]
        want.setdefault(doc_id, []).extend(pieces)
    assert sorted((r.doc_id or -1, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted((d or -1, *p) for d, ps in want.items() for p in ps)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append(r)
    for rs in bins.values():
        rs.sort(key=lambda r: r.offset)
        assert [r.offset for r in rs] == np.cumsum([0, *[r.length for r in rs]])[:-1].tolist()
        assert (np.array([sum(r.length for r in rs), len(rs), sum(r.length**2 for r in rs)]) <= caps.limits).all()
    # groups of 50 cost hardly more sequences than one group
    alone = best_fit.best_fit(np.sort([r.length for r in got])[::-1], caps)[2]
    assert len(bins) <= len(alone) * 1.02 + 1
    whole = {r.sequence_id: r for r in best_fit.sequences(out).collect()}
    assert all(whole[k].ids == [x for r in rs for x in r.ids] and whole[k].doc_starts == [r.offset for r in rs] for k, rs in bins.items())
    assert best_fit.pack_documents(df.where("false"), characters(), caps).count() == 0


def test_op11_by_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    texts = [*ODD, *[" ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 50, 900]))) for _ in range(60)]]
    got = best_fit.op11(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    want = set()
    for i, t in enumerate(texts):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        want |= {(i, p, s, min(2048, len(ids) - s), zlib.crc32(np.array(ids[s : s + 2048], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 2048))}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    # one group: the sequences are those of best-fit over all pieces
    assert len({r.sequence_id for r in got}) == len(one_by_one(sorted((r.length for r in got), reverse=True), best_fit.Capacities(), "norm")[2])


# --- vector codes ---


def lloyd(vectors, ids, parts, entries, rounds):
    """All parts against all entries, in plain integers."""
    x = np.floor(np.array(vectors, float) * 256).astype(np.int64).reshape(len(vectors), parts, -1)
    books = x[np.argsort(ids, kind="stable")[:entries]].swapaxes(0, 1).copy()
    for turn in range(rounds + 1):
        d = ((x[:, :, None] - books[None]) ** 2).sum(-1)
        code = d.argmin(-1)
        if turn < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    if (code[:, p] == e).any():
                        books[p, e] = x[code[:, p] == e, p].sum(0) // (code[:, p] == e).sum()
    return code, d.min(-1).sum(1), books


@pytest.mark.parametrize(("n", "leaf", "spread"), [(1, 4, 9), (700, 5, 2), (700, 30, 40), (900, 1, 1), (64, 64, 9)])
def test_trees_own_every_point_as_brute_force_does(n, leaf, spread):
    rng = np.random.default_rng(n + leaf)
    points = rng.integers(-spread, spread + 1, (n, 3))
    tree = ball_trees.build_tree(points, leaf)
    assert sorted(tree.order.tolist()) == list(range(n))
    for i in range(len(tree.lo)):
        ball = points[tree.order[tree.lo[i] : tree.hi[i]]]
        assert (ball.sum(0) == tree.sums[i]).all() and ((ball - tree.pivot[i]) ** 2).sum(1).max() == tree.radius[i]
    book = points[rng.integers(0, n, 40)]
    balls, single = ball_trees.owners(tree, points, book)
    got = np.full(n, -1)
    for nodes, own in balls:
        for node, o in zip(nodes, own, strict=True):
            got[tree.order[tree.lo[node] : tree.hi[node]]] = o
    for places, own in single:
        got[places] = own
    assert (got == ((points[:, None] - book[None]) ** 2).sum(2).argmin(1)).all()


@pytest.mark.parametrize("labels", [ball_trees.LABELS, 0])
def test_vector_codes(spark, monkeypatch, labels):
    monkeypatch.setattr(ball_trees, "LABELS", labels)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(400, 8)).round(2)
    vectors[100:250] = vectors[100]
    vectors = [list(map(float, v)) for v in vectors]
    ids = [None if 120 <= i < 140 else 7 if 200 <= i < 240 else 1000 - i for i in range(400)]
    label = [None if i % 3 == 0 else i % 5 for i in range(400)]
    odd = [None, [], [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [1.0, None] + [1.0] * 6]
    other = [[1.0] * 4, [1e30] * 8, [1e308] * 8]
    rows = [(i, v, x, "c") for i, v, x in zip(ids, vectors, label, strict=True)] + [(i, v, 9, "c") for i, v in enumerate(odd + other)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string")
    out, books = ball_trees.vector_codes(df, parts=4, entries=16, rounds=2, block=50)
    code, error, want_books = lloyd(vectors, [2000 if i is None else i for i in ids], 4, 16, 2)
    # equal ids: by vector; the seven are equal
    assert (books == want_books).all()
    total = {}
    for x, e in zip(label, error, strict=True):
        total[x] = total.get(x, 0) + int(e)
    digest = hashlib.sha256(",".join(map(str, want_books.ravel().tolist())).encode()).hexdigest()
    want = [(i or 0, c.astype(np.uint8).tobytes().hex(), int(e), total[x], digest) for i, c, e, x in zip(ids, code, error, label, strict=True)]
    got = [(r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect()]
    assert sorted(g for g in got if g[1]) == sorted(want)
    assert sorted(g[0] for g in got if g[1] is None) == [5, 6, 7]
    none = ball_trees.op12(df.where("false"))
    assert none.count() == 0 and none.columns == out.columns
    few, _ = ball_trees.vector_codes(df.where("vec_id > 990"), parts=4)
    assert few.where("error = 0").count() == few.where("code IS NOT NULL").count() == 10


# --- fill in the middle ---


def infilled(doc_id, text, seed=7):
    import re

    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i : i + 8], 16) for i in range(0, 32, 8)]
    lo, hi = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:lo]), "".join(lines[lo:hi]), "".join(lines[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, text
    form = "spm" if h[3] % 100 < 50 else "psm"
    return len(lines), form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@pytest.mark.parametrize("piece", [3, fill_middle.PIECE_BYTES])
def test_fill_in_middle(spark, piece):
    rng = random.Random(5)
    texts = [*ODD, *["".join(rng.choice(["a", "é", "\n", "<", "P>"]) for _ in range(rng.randrange(60))) for _ in range(80)]]
    rows = [(i if i % 7 else None, t, "x", 3) for i, t in enumerate(texts)] + [(5, "twice\nhere\n", "x", 3)] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, pos int")
    out = fill_middle.restore_texts(fill_middle.fill_in_middle(df, piece_bytes=piece))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for doc_id, text, *_ in rows:
        *head, output = infilled(doc_id, text or "")
        want.append(repr((doc_id, *head, sha(output), sha(text or ""), output, text or "")))
    got = [repr((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256, r.output.decode(), r.restored)) for r in out.collect()]
    assert sorted(got) == sorted(want)
    assert fill_middle.op13(df.where("false")).count() == 0


def test_fill_by_characters_and_rates(spark):
    df = spark.createDataFrame([(i, "añb c" * (i % 9)) for i in range(300)], "doc_id long, text string")
    out = fill_middle.restore_texts(fill_middle.fill_in_middle(df, unit="character", fim_percent=60, spm_percent=0, piece_bytes=4)).join(df, "doc_id")
    assert out.where("restored <> text OR n <> length(text)").count() == 0
    forms = {r.form: r["count"] for r in out.groupBy("form").count().collect()}
    assert set(forms) == {"psm", "plain"} and 130 < forms["psm"] < 190
    assert out.where((F.col("form") == "psm") & (F.col("prefix_chars") + F.col("middle_chars") > F.length("text"))).count() == 0
