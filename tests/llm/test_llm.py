"""The training-data operators against brute force, libraries and SQL, with edge cases."""

import hashlib
import math
import os
import random
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import byte_bpe, common, decontaminate, embed_dedup, minhash, queries, secrets, sharding, token_output, toxicity, url_filter, warc
from skyledger.llm.common import connected_components

SF = os.environ.get("SKYLEDGER_SF", "/root/testdata/sf0.001")
public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, `_text` string"


def make(spark, texts):
    """Documents with a null id, repeated rows and clashing extra columns."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[0]], DOCS)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD = [None, "", " ", "a", "Ünïcode İ ſ ß . , 7 é. 'LL <|endoftext|> \x1c\x85\u2028", "x" * 5000, "password: hunter22 token = abc KEY\n\n", "ab " * 3000]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}'")
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    assert cols == sorted(names)
    want = sorted(repr([r[names.index(c)] for c in cols]) for r in res.fetchall())
    assert sorted(repr([r[c] for c in cols]) for r in df.collect()) == want


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<title>T &amp; U</title><script>x<p></script><!-- c --><p>A&lt;b&gt;<br>c  d</p>"), (2, None, None)], "page_id long, url string, html string")
    got = {(r.page_id, r.record_type): r for r in warc.op1(pages).collect()}
    assert len(got) == 4 and got[1, "conversion"].block == "A<b>\nc d" and got[2, "conversion"].block == ""
    r = got[1, "metadata"]
    assert r.refers_to == got[1, "conversion"].refers_to and f"WARC-Refers-To: {r.refers_to}\r\n" in r.warc_header and "http-header: HTTP/1.1 200 OK\r\n" in r.block
    assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
    assert "title: T & U" in r.block and warc.op1(pages.where("false")).count() == 0


def test_warc_odd_pages(spark):
    html = "<title>&#8217;&eacute;</title><p>&#x41;&#x1F600;&#0;&#xD800;&unknown;&amp;lt; &hellip;<!-- never closed <p>x"
    pages = spark.createDataFrame([(1, "http://a/\r\nX-Evil: 1", html), (1, "http://a/\r\nX-Evil: 1", "<p>other"), (None, "u", None), (None, "u", None)], "page_id long, url string, html string")
    rows = warc.op1(pages).collect()
    assert len(rows) == 8 and len({r.record_id for r in rows}) == 6 and len({r.refers_to for r in rows}) == 3
    assert all("\r\nX-Evil" not in r.warc_header and ("WARC-Target-URI: http://a/%0D%0AX-Evil: 1\r\n" in r.warc_header or r.page_id is None) for r in rows)
    assert next(r.block for r in rows if r.record_type == "conversion" and "😀" in r.block) == "A😀\ufffd\ufffd&unknown;&lt; …"
    assert any(r.block.startswith("title: ’é\r\n") for r in rows)


def test_warc_blocks(spark):
    """Cells, rows, sections, preformatted text, quotations and lists of terms don't run into each other; inline tags part nothing."""
    html = (
        "<table class=x><tr><th>n</th><td>a</td><td\n>b</td></tr><tr><td>c<td>d</table>x<section id='1'>s</section><pre>p  q</pre>r<BLOCKQUOTE>t</BLOCKQUOTE>"
        "<dl><dt>u</dt><dd>v</dd></dl>one<b>two</b><i>3</i><prefix>4</prefix><th5>5<h5>6</h5>7<p/>8<ul><li>9<li>10</ul>"
    )
    pages = spark.createDataFrame([(1, "http://a/", html)], "page_id long, url string, html string")
    [block] = [r.block for r in warc.op1(pages).collect() if r.record_type == "conversion"]
    assert block == "n a b\nc d\nx\ns\np q\nr\nt\nu\nv\nonetwo345\n6\n7\n8\n9\n10"
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.execute("INSERT INTO pages VALUES (1, 'http://a/', ?)", [html])
    assert block in [r[-1] for r in con.execute(queries.ORACLE_SQL["op1_warc_derivatives"]).fetchall()]


@pytest.mark.parametrize("piece", ["<!-- ", "<script ", "<script>", "</script", "<a ", "<", "<title>", "&#", "<br "])
def test_warc_long_pages(spark, piece):
    pages = spark.createDataFrame([(1, "u", piece * 20_000)], "page_id long, url string, html string")
    began = time.time()
    assert warc.op1(pages).count() == 2 and [r.record_type for r in warc.op1(pages).collect()].count("conversion") == 1
    assert time.time() - began < 20


def test_embeddings(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 8))
    rows = [base[i % 40] + rng.normal(scale=0.15, size=8) for i in range(150)] + [base[0]] * 3
    vectors = [list(map(float, v)) for v in rows] + [None, [], [0.0] * 8, [float("nan")] + [1.0] * 7, [1.0, None] + [1.0] * 6, [1.0, 2.0]]
    df = spark.createDataFrame([(i, v, "clash") for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, key string")
    got = {r.vec_id: r for r in embed_dedup.embedding_duplicates(df, block=16).collect()}
    x = np.array(vectors[:153])
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = (u @ u.T >= 0.9) & ~np.eye(153, dtype=bool)
    label = np.arange(153)
    for _ in range(153):
        label = np.array([min([label[i], *label[link[i]]]) for i in range(153)])
    for i in range(len(vectors)):
        want = (int(link[i].sum()), int(label[i])) if i < 153 else (0, i)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (*want, want[1] == i)
    assert embed_dedup.op2(df.where("false")).count() == 0


def test_embeddings_of_any_size(spark):
    vectors = [[1e200, 1e200], [1e200, 1e200], [1e-200, 1e-200], [5e-324, 5e-324], [1.0, -1.0], [1e308, 9e307], [0.9, math.sqrt(1 - 0.81)], [1.0, 0.0], [1.0] * 3, [2.0, 2.0, 2.0], [7.0]]
    rows = [(i if i != 3 else None, v) for i, v in enumerate(vectors)] + [(8, [1.0] * 3)]
    got = sorted(tuple(r)[1:] + (r.vec_id,) for r in embed_dedup.op2(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect() if r.vec_id is not None)
    n, part = {g[3]: g[0] for g in got}, {g[3]: g[1] for g in got}
    assert [n[i] for i in (0, 1, 2, 5, 4, 10)] == [5, 5, 5, 5, 0, 0] and part[2] == part[5] == 0
    assert n[8] == n[9] == 2 and part[9] == 8 and part[6] == 0 and n[6] >= 5
    assert embed_dedup.cosines(np.array([[0.9, 0.1]]), np.array([[0.9, 0.1]]))[0] == pytest.approx(1)
    single, double = np.array([[0.5, 0.25]]), np.array([[0.1, 0.2]])
    assert len(embed_dedup.packed(single)) == 8 and len(embed_dedup.packed(double)) == 16
    assert all((embed_dedup.unpacked(embed_dedup.packed(v), 1, 2) == v).all() for v in (single, double))


def test_shards(spark):
    df = make(spark, ["t"] * 300 + ODD).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "hot").otherwise(F.col("source")))
    rows = sharding.op3(df).collect()
    n = len(rows)
    assert n == df.count()
    by = {k: sorted(r.slot for r in rows if r.shard == k) for k in range(16)}
    assert all(v == list(range(len(v))) for v in by.values()) and max(map(len, by.values())) - min(map(len, by.values())) <= 1
    hot = [sum(1 for r in rows if r.shard == k and r.doc_id % 2 == 0) for k in range(16)]
    assert max(hot) - min(hot) <= 2
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id == 300} == {(1, 0)}
    assert sharding.op3(df.where("false")).count() == 0


def plain_shards(rows, n_shards):
    """Places by sorting each source and all rows, in plain Python; rows are (source, key, id)."""
    sources = {}
    for source, key, i in rows:
        sources.setdefault(source, []).append((key, i))
    placed = []
    for source, held in sources.items():
        held.sort()
        placed += [((at + 0.5) / len(held), source, key, i) for at, (key, i) in enumerate(held)]
    placed.sort()
    n = len(placed)
    shard = [p * n_shards // n for p in range(n)]
    return sorted((i, k, p - shard.index(k)) for p, ((*_, i), k) in enumerate(zip(placed, shard, strict=True)))


@pytest.mark.parametrize("stretch", [7, 65_536])
def test_shards_of_equal_rows(spark, monkeypatch, stretch):
    """A third and more of all rows are equal in everything: they count as many, and no task makes them all."""
    monkeypatch.setattr(sharding, "STRETCH", stretch)
    rng = random.Random(4)
    key = lambda x: hashlib.md5(str(x).encode()).hexdigest()
    rows = [("a", key("same"), 5)] * 9000 + [(rng.choice("abc"), key(i), i) for i in range(5000)] + [("c", key(3), 3)] * 40 + [("d", key(1), 1)] * 3
    df = spark.createDataFrame(rows, "source string, order_key string, doc_id long")
    out = sharding.stratified_shards(df, 16, carry=("doc_id",))
    assert sorted(map(tuple, out.collect())) == plain_shards(rows, 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        by_task = sharding.stratified_shards(df, 16, carry=("doc_id",)).where("doc_id = 5").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(by_task) == 4 and max(r["count"] for r in by_task) < 3000
    few = spark.createDataFrame([("a", "000", 1)] * 5, "source string, order_key string, doc_id long")
    assert sorted(map(tuple, sharding.stratified_shards(few, 3, carry=("doc_id",)).collect())) == plain_shards([("a", "000", 1)] * 5, 3)


def test_urls(spark):
    urls = [None, "", "no", "http://A.B.example.NET/en/x?q", "http://example.net/en", "http://example.net", "http://net/", "http://x.org/fr/", "http://x.com/de/y", "http://a.example.com/de/", "http://notexample.com/de/", "x://h\n/p"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in url_filter.op4(df).orderBy("page_id").collect()]
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.b.example.net", "/en/x", "example.net/en/", "allow") and got[4][2:] == ("net/", "block") and got[5] == ("example.net", "", None, "allow")
    assert [g[2] for g in got[6:]] == ["net/", "org/fr/", None, "example.com/de/", None, None]
    joined = url_filter.judge_urls(df, url_filter.RULES, id_col="page_id", max_trie_bytes=0).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in joined] == got


def test_url_ties(spark):
    for rules in ([("com", "/abcd", "block"), ("A.com", "/ab", "allow")], [("a.com", "/ab", "allow"), ("com", "/abcd", "block")], [("a.com", "/ab", "block"), ("a.com", "/ab", "allow")]):
        df = spark.createDataFrame([(None, "http://a.com/abcd"), (1, "http://x.a.com/abcd"), (1, "http://b.com/abcd")], "page_id int, url string")
        got = [sorted(map(repr, url_filter.judge_urls(df, rules, id_col="page_id", max_trie_bytes=n).collect())) for n in (1 << 20, 0)]
        assert got[0] == got[1] and sum("verdict='allow'" in r and "a.com/ab" in r for r in got[0]) == 2
    with pytest.raises(ValueError):
        url_filter.judge_urls(df, [("", "/", "block")], id_col="page_id")


@pytest.mark.parametrize("bits, width", [(True, 17), (False, 24), (False, 32)])
def test_planes(bits, width):
    rng = np.random.default_rng(0)
    for n in (0, 1, 99, 100, 101, 1000):
        ids = rng.integers(0, 1 << 16, n).astype(np.uint32)
        payload, index = token_output.shuffle_planes(ids, width, 100, bits)
        assert (token_output.unshuffle_planes(payload, index, n, width, 100, bits) == ids).all()
    with pytest.raises(ValueError):
        token_output.shuffle_planes(np.array([1 << 30], np.uint32), 17, 10)


def test_token_output(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(2)
    odd = ["".join(rng.choice(["a", "B", ".", ",", ". ", "é. ", " ", "\n", "\x1c", "Σ", "İ", "'s", "7", "😀", chr(rng.randrange(0x20, 0x3000))]) for _ in range(80)) for _ in range(60)]
    texts = ODD + odd
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = 0
    for r, t in zip(token_output.op5(df).orderBy("doc_id").collect(), texts, strict=True):
        ids = np.array(tk.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert token_output.op5(df.where("false")).count() == 0


def test_token_output_special_case(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["plain One, two.", "a <|EndOfText|> B.", "", "<|endoftext|>", "<|ENDOFTEXT|>x. <|StartOfText|>", "last, one", "<|"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = 0
    for r, t in zip(token_output.op5(df).orderBy("doc_id").collect(), texts, strict=True):
        ids = np.array(tk.encode(t, add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def entropy(s):
    return -sum(s.count(c) / len(s) * math.log2(s.count(c) / len(s)) for c in set(s))


def test_secrets(spark):
    rng = random.Random(4)
    key = "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789") for _ in range(40))
    texts = [*ODD, f"é 😀 {key} end", "API_KEY='abc.def/gh' x AKIA" + "Q1" * 9 + " deadbeef" * 2 + " 0123456789abcdef01234567 secret: token: abcdefg", "ordinaryordinaryordinary example" + key]
    df = make(spark, texts)
    found = {r.doc_id: r for r in secrets.op6(df).collect()}
    n = len(ODD)
    assert found[n].spans == f"entropy:4:{4 + 40}" and found[n + 2].spans == ""
    assert (found[n + 1].n_assign, found[n + 1].n_access, found[n + 1].n_hex) == (1, 1, 1)
    assert found[0].spans == "" and found[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    red = {r.doc_id: r.text for r in secrets.redact(secrets.find_secrets(df)).collect()}
    assert red[n] == "é 😀 [SECRET] end" and red[0] is None and red[5] == ODD[5]
    for s in [key, "a" * 30, "ab" * 15, key[:20], "short"]:
        got = spark.range(1).select(secrets.window_entropy(F.lit(s), 20).alias("e")).first().e
        assert got == pytest.approx(max([entropy(s[i : i + 20]) for i in range(len(s) - 19)], default=0), abs=1e-9)


def test_long_text_of_secrets(spark):
    pieces = {"token=abc123 ": 20_000, "AKIA" + "Q" * 20 + " ": 20_000, "token='abc123456789012345678901' x ": 20_000}
    for piece, n in pieces.items():
        df = spark.createDataFrame([(1, piece * n, "a", "b")], "doc_id long, text string, base string, clear string")
        began = time.time()
        r = secrets.op6(df).collect()[0]
        assert r.n_assign + r.n_access == n and time.time() - began < 20
        found = secrets.redact(secrets.find_secrets(df, out="spans"), "spans").collect()[0]
        assert found.text.count("[SECRET]") == n and (found.base, found.clear) == ("a", "b")


def test_candidates_clear_of_base_spans(spark):
    """The running totals against every pair, for spans that touch, nest, repeat or are absent."""
    rng = random.Random(11)
    rows = []
    for k in range(300):
        cuts = sorted(rng.sample(range(400), 2 * rng.randrange(0, 40)))
        free = [(a, b) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        base = sorted((a, a + rng.randrange(1, rng.choice((5, 60)))) for a in (rng.randrange(400) for _ in range(rng.randrange(0, 200 if k % 9 == 0 else 6))))
        rows.append((k, [(a, 0, "assign", b) for a, b in base], [(a, 3, "entropy", b) for a, b in free]))
    span = "array<struct<start:int,rank:int,kind:string,end:int>>"
    df = spark.createDataFrame(rows, f"k int, base {span}, free {span}")
    for r in df.withColumn("got", secrets._clear(F.col("base"), F.col("free"))).collect():
        assert [tuple(x) for x in r.got] == [tuple(c) for c in r.free if not any(b.start < c.end and c.start < b.end for b in r.base)]


def test_winnowing(spark, monkeypatch):
    rng = random.Random(5)
    items = [" ".join(words(rng, n)) for n in (30, 13, 20, 5, 1)] + [None, "", "..."]
    texts = [*ODD]
    for _ in range(60):
        w = words(rng, rng.randrange(0, 80))
        item = items[rng.randrange(5)].split()
        a = rng.randrange(len(item))
        at = rng.randrange(len(w) + 1)
        texts.append(" ".join(w[:at] + item[a : a + rng.randrange(1, 30)] + w[at:]).upper())
    bench = spark.createDataFrame([(f"i{k}", t) for k, t in enumerate(items)], "item_id string, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    windows = []
    for k, t in enumerate(items):
        w = decontaminate.words_of(t)
        windows += [(f"i{k}", w[p : p + 13]) for p in range(max(1, len(w) - 12))] if w else []
    for filter_bytes in (1 << 20, 8):  # a filter of 64 bits lets everything through
        monkeypatch.setattr(common, "MAX_FILTER_BYTES", filter_bytes)
        for r in decontaminate.judged(decontaminate.contamination(df, bench)).collect():
            w, hit, found = decontaminate.words_of(texts[r.doc_id]), set(), set()
            for name, g in windows:
                for p in range(len(w) - len(g) + 1):
                    if w[p : p + len(g)] == g:
                        hit.update(range(p, p + len(g)))
                        found.add(name)
            assert (r.n_words, r.n_hit, r.items) == (len(w), len(hit), sorted(found))


@pytest.mark.parametrize("filter_bytes", [1 << 20, 8])
def test_decontamination_odd_ids(spark, monkeypatch, filter_bytes):
    monkeypatch.setattr(common, "MAX_FILTER_BYTES", filter_bytes)
    rng = random.Random(10)
    items = [" ".join(words(rng, 20)) for _ in range(6)]
    bench = spark.createDataFrame([(f"i{k}" if k else None, t) for k, t in enumerate(items)], "item_id string, text string")
    clean = [" ".join(words(rng, 30, 5000)) for _ in range(3)]
    data = [(None, items[1], "a"), (None, clean[0], "b"), (7, items[2] + " x " + items[3], "c"), (7, clean[1], "d"), (7, clean[1], "d"), (8, items[0], "e"), (None, None, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    got = decontaminate.judged(decontaminate.contamination(df, bench, keep=("text", "lang"))).collect()
    want = [(None, 20, 20, ["i1"], items[1], "a"), (None, 30, 0, [], clean[0], "b"), (7, 41, 40, ["i2", "i3"], items[2] + " x " + items[3], "c"), *[(7, 30, 0, [], clean[1], "d")] * 2, (8, 20, 20, [], items[0], "e"), (None, 0, 0, [], None, None)]
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, r.n_hit, r["items"], r.text, r.lang)) for r in got)
    bare = decontaminate.contamination(df, bench)
    assert bare.columns == ["doc_id", "n_words", "spans", "items"] and bare.count() == len(data)
    none = decontaminate.contamination(df, bench.where("false"))
    assert none.count() == len(data) and none.where("size(spans) + size(items) > 0").count() == 0 and decontaminate.op7(df.where("false"), bench).count() == 0


def test_decontamination_like_sql(spark, tmp_path):
    """Repeated and null ids of items, runs of one word, ties and empty texts, against the operator's SQL."""
    rng = random.Random(12)
    items = [("i1", "a " * 30), ("i2", "A" + " a" * 12), (None, " ".join(words(rng, 25, 9))), ("i3", "b c b c"), ("i3", "x y"), ("i4", ""), ("i5", None), ("i6", "a " * 30), ("i7", " ".join(words(rng, 60, 2)))]
    texts = [None, "", "..."] + [" ".join(rng.choice([["a"] * rng.randrange(40), words(rng, 30, 9), words(rng, 80, 2), ["b", "c", "b", "c", "x", "y"]]) + words(rng, rng.randrange(20), 2)) for _ in range(80)] + [items[2][1] * 2]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, marks string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    res = con.execute(decontaminate.op7_sql())
    names = [d[0] for d in res.description]
    df = decontaminate.op7(*[spark.read.parquet(str(tmp_path / f"{t}.parquet")) for t in ("documents", "benchmark")])
    assert sorted(repr([r[c] for c in names]) for r in df.collect()) == sorted(repr(list(r)) for r in res.fetchall())


@pytest.mark.parametrize("small", [None, 1])
def test_minhash(spark, monkeypatch, small):
    if small:  # all buckets are large, and blocks small
        monkeypatch.setattr(minhash, "SMALL_BUCKET", small)
        monkeypatch.setattr(minhash, "BLOCK_NODES", 8)
    rng = random.Random(6)
    base = words(rng, 120, 5000)
    texts = [*ODD, "only", "ONLY", "two words"]
    for _ in range(60):
        w = base[:]
        for _ in range(rng.randrange(0, 12)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    texts += [" ".join(words(rng, 50, 5000)) for _ in range(20)] + [" ".join(base)] * 5
    df = make(spark, texts)
    sets = [minhash.shingle_set(minhash.words_of(t), 2) for t in texts]
    label = list(range(len(texts)))
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    for _ in texts:
        for i, j in pairs:
            label[i] = label[j] = min(label[i], label[j])
    got = minhash.near_duplicates(df, shingle=2, star_rounds=1 if small else 3).collect()
    assert len(got) == len(texts) + 1
    assert all((r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), label[r.doc_id], label[r.doc_id] == r.doc_id) for r in got)
    assert minhash.op8(df.where("false")).count() == 0
    nulls = df.limit(3).withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.kept for r in minhash.op8(nulls).collect()] == [True] * 3


def test_minhash_shared_id(spark):
    rng = random.Random(7)
    one, two = words(rng, 60, 5000), words(rng, 60, 5000)
    rows = [(5, " ".join(one)), (5, " ".join(two)), (9, " ".join([*one, "more"])), (7, " ".join([*two, "more"])), (3, "alone here")]
    got = sorted(tuple(r) for r in minhash.op8(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert got == [(3, 3), (5, 5), (5, 5), (7, 5), (9, 5)]


def test_circulant_shift():
    h = np.array([5 << 32, 9 << 32], np.uint64)
    moved = h + np.uint64(3 << 32)
    assert (minhash.circulant_signature(h, 20)[3:] == minhash.circulant_signature(moved, 20)[:17]).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (41, 50), (60, 60)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and got[41] == got[50] == 40 and 60 not in got


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_fuzzy_lexicon_is_edit_distance(edits):
    """Random lexicons over few letters, so that words lie close together, against plain dynamic programming."""
    rng = random.Random(edits)
    word = lambda low, high: "".join(rng.choice("abé") for _ in range(rng.randint(low, high)))
    for _ in range(12):
        terms = {word(3, 8): 1.0 for _ in range(12)}
        stems = {word(3, 6): 1.0 for _ in range(4)}
        lexicon = toxicity.FuzzyLexicon(terms, stems, edits=edits)
        held, heads = [t for t in terms if len(t) >= toxicity.FUZZY_FROM], [t for t in stems if len(t) >= toxicity.FUZZY_FROM]
        asked = [word(1, 10) for _ in range(80)] + list(terms) + [s + word(0, 5) for s in stems]
        for w in asked:
            near = min(((d, t) for t in held if (d := edit_distance(w, t)) <= edits), default=None)
            stem = min(((d, t) for t in heads if (d := min(edit_distance(w[:n], t) for n in range(1, len(w) + 1))) <= edits), default=None)
            assert lexicon.near(w) == (near and near[::-1]), (w, terms)
            assert lexicon.near_stem(w) == (stem and stem[::-1]), (w, stems)


def test_toxicity(spark):
    rng = random.Random(7)
    bad = ["grobnik", "fizzwart", "plonker"]
    texts, labels = [], []
    for i in range(900):
        w = words(rng, 40)
        toxic = i % 4 == 0
        if toxic:
            w[rng.randrange(40)] = rng.choice(bad)
        texts.append(" ".join(w))
        labels.append((i, 1, int(toxic)))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    extra = ["you fizwart", 'he said "grobnik" was the word', "", None, "plonkers of the world"]
    df = make(spark, texts + extra)
    got = {r.doc_id: r for r in toxicity.op9(df, lab).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out for i in held) and sum(got[i].predicted == (i % 4 == 0) for i in held) / len(held) > 0.97
    assert [got[900 + k].predicted for k in range(5)] == [1, 0, 0, 0, 1]
    assert all(0 <= r.score <= 1 for r in got.values())
    assert toxicity.op9(df, lab.where("false")).where("predicted = 1").count() == 0
    none = toxicity.op9(df.withColumn("doc_id", F.lit(None).cast("long")), lab)
    assert {r.held_out for r in none.collect()} == {False} and none.count() == len(texts) + 6
    lex = toxicity.FuzzyLexicon({}, {"abcdef": 1.0, "wxyz": 1.0})
    assert [lex.near_stem(w) for w in ("abcdefgh", "abdefgh", "xabcdefgh", "abXdefgh", "abdfgh", "wxyza", "wxza")] == [("abcdef", 0), *[("abcdef", 1)] * 3, None, None, None]
    assert [lex.stem(w) for w in ("wxyza", "wxza")] == ["wxyz", None]
    far = toxicity.ToxicityModel(-1.0, {"grobnik": 6.0})
    long = 'he said ' + "a" * 500 + ' "grobnik" was'
    assert far.score(long)[1] == 0 and far.score("you grobnik")[1] == 1 and far.score("x " * 5000 + "grobnik")[1] == 1
    lex = toxicity.FuzzyLexicon({"fizzwart": 1.0}, {})
    assert [lex.near(w) is not None for w in ("fizzwart", "fizwart", "fizzwarts", "fizzw4rt", "xizzwart", "fizart", "fizz", "")] == [True] * 5 + [False] * 3


def test_byte_bpe(spark):
    import tiktoken

    tokens = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(8)
    texts = ODD + ["".join(chr(rng.choice([rng.randrange(0x20, 0x7F), rng.randrange(1, 0x3000), rng.randrange(0x1F300, 0x1F700), 0x20, 0x85])) for _ in range(200)) for _ in range(40)]
    df = make(spark, texts)
    got = byte_bpe.encode_texts(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = texts[r.doc_id] or ""
        ids = enc.encode_ordinary(text)
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    texts = [" ".join(words(rng, 60, 3000)) for _ in range(400)]
    item = " ".join(words(rng, 40, 3000))
    for i in range(0, 400, 5):
        texts[i] += " grobnik"
    texts[1] = item
    texts[2] = texts[3]
    texts[4] = "password=hunter2222 " + texts[4]
    make(spark, texts).where("doc_id IS NOT NULL").limit(400).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i for i in range(400) if i % 5} - {1, 3}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    red = corpus_pipeline.redact_secrets(spark, docs, str(tmp_path)).where("doc_id = 4").first()
    assert red.text.startswith("[SECRET] ") and red.n_chars == len(red.text)


def jaccard(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def test_pipeline_brute_force(spark, tmp_path):
    """All five stages on one fixture against plain Python, with null and repeated ids, ties, empty texts and a clashing column."""
    import corpus_pipeline
    import tiktoken

    rng = random.Random(13)
    texts = [" ".join(words(rng, rng.randrange(20, 80), 4000)) for _ in range(260)]
    items = [" ".join(words(rng, 30, 4000)) for _ in range(3)] + [" ".join(words(rng, 6, 4000))]
    toxic = set(range(0, 200, 4))
    for i in toxic:
        w = texts[i].split()
        w[rng.randrange(len(w))] = "grobnik"
        texts[i] = " ".join(w)
    for i in range(201, 230):  # near and exact copies in groups
        w = texts[200 + i % 3].split()
        if i % 2:
            w[rng.randrange(len(w))] = f"z{i}"
        texts[i] = " ".join(w)
    texts[231] = items[0] + " " + texts[231]
    texts[232] = texts[232] + " " + items[3].upper()
    texts[233] = " ".join(items[1].split()[:12]) + " q " + texts[233]
    texts[234] = "token=abcdef123456 " + texts[234]
    texts[235:238] = ["", " ", texts[238]]
    rows = [(i if i % 50 != 9 else None, t, "en", "s", len(t), "x") for i, t in enumerate(texts)] + [(5, None, "en", None, None, "x"), (240, texts[240], "en", "s", 1, "x")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, tuple(r.ids)) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())

    kept = [r for r in rows if "grobnik" not in (r[1] or "").split()]
    sets = [minhash.shingle_set(minhash.words_of(r[1]), 5) for r in kept]
    part = list(range(len(kept)))
    for _ in kept:
        for i in range(len(kept)):
            for j in range(i):
                if sets[i] and sets[j] and jaccard(sets[i], sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
    best = {}
    for i, r in enumerate(kept):
        key = (r[0] is None, r[0] or 0, i)
        best[part[i]] = min(best.get(part[i], (key, i)), (key, i))
    kept = [kept[i] for _, i in best.values()]
    grams = {tuple(w[p : p + min(13, len(w))]) for w in map(decontaminate.words_of, items) for p in range(max(1, len(w) - 12))}

    def clean(text):
        w, hit = decontaminate.words_of(text), set()
        for n in {len(g) for g in grams}:
            for p in range(len(w) - n + 1):
                if tuple(w[p : p + n]) in grams:
                    hit.update(range(p, p + n))
        return not (hit and 20 * len(hit) >= len(w))

    kept = [r for r in kept if clean(r[1])]
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={})
    want = []
    for r in kept:
        ids = enc.encode_ordinary((r[1] or "").replace("token=abcdef123456", "[SECRET]"))
        want.append((-1 if r[0] is None else r[0], len(ids), tuple(ids)))
    assert got == sorted(want) and {231, 232}.isdisjoint(g[0] for g in got) and any(g[0] == 233 for g in got)


def test_pipeline_duplicates_odd_ids(spark):
    import corpus_pipeline

    rng = random.Random(11)
    one, two, three, four = (" ".join(words(rng, 60, 5000)) for _ in range(4))
    data = [(5, one), (5, two), (9, one + " more"), (None, three), (None, three + " more"), (None, two), (None, four), (7, None), (7, ""), (3, four), (3, four)]
    got = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(data, "doc_id long, text string"), "").collect()
    kept = [tuple(r) for r in got]
    assert len(kept) == 6 and {(5, one), (5, two), (3, four), (7, None), (7, "")} < set(kept)
    assert sum(t in ((None, three), (None, three + " more")) for t in kept) == 1


def test_minhash_null_and_many_shared_ids(spark):
    rng = random.Random(8)
    a = words(rng, 101, 5000)
    b, c = [*a], [*a]
    for w in (b, c):
        w[10] = w[20] = w[30] = "x1"
    for k in (50, 60, 70):
        c[k] = "y1"
    rows = [(1, " ".join(a)), (None, " ".join(b)), (2, " ".join(c)), (None, "same text here"), (None, "same text here"), (None, None), (None, "")]
    sets = [minhash.shingle_set(minhash.words_of(t), 2) for _, t in rows[:3]]
    assert 100 * len(sets[0] & sets[2]) < 80 * len(sets[0] | sets[2])
    got = minhash.op8(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0), r.component_id or 0, r.kept) for r in got if r.n_shingles > 5) == [(0, 1, False), (1, 1, True), (2, 1, False)]
    assert sorted(r.kept for r in got if r.n_shingles == 2) == [False, True] and [r.kept for r in got if not r.n_shingles] == [True, True]
    # a third of the rows under one id: candidates grow with the rows
    made = []
    for i in range(600):
        w = words(rng, 30, 5000)
        made += [(7 if i % 3 else i + 10, " ".join(w)), (7 if i % 3 else -i - 10, " ".join([*w, "more"]))]
    out = minhash.op8(spark.createDataFrame(made, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(d, 7 if i % 3 else -i - 10) for i in range(600) for d in ([7] if i % 3 else [i + 10, -i - 10])}


def test_tables_of_two_threads(spark):
    """What one thread writes isn't deleted with the tables of another."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    meet = Barrier(2)

    def one(k):
        def make():
            meet.wait(60)
            inner = common.written(spark.range(k), "inner")
            meet.wait(60)
            return inner

        out = common.written_alone(make, "outer")
        meet.wait(60)
        return out.count()

    with ThreadPoolExecutor(2) as pool:
        assert list(pool.map(one, [3, 5])) == [3, 5]
