"""Allow and block rules on URLs by a trie over reversed host labels and path segments.

A rule is (host, path, verdict). It fits its host and every subdomain, if the
URL's path starts with the rule's path. Of the rules that fit, the one of most characters in host and
path together wins; of equal ones the one with the longer host. There are no further ties: two rules that fit
one URL and are as long in host and in path are the same rule, and of rules given twice the last counts.
The trie walks host labels from the right (``net``, ``example``, ...), then the
path's segments; the last segment of a rule's path is a prefix of the URL's
segment at that depth (so ``/en/`` asks for something after ``/en``, be it empty).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Beyond this many bytes of rules the trie isn't broadcast; rules are then joined.
MAX_TRIE_BYTES = 32 << 20

Rule = tuple[str, str, str]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    url = F.coalesce(url, F.lit(""))
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def build_trie(rules: list[Rule]) -> dict:
    """Nested dicts; under "" of a host node stands the trie of path segments, under None of a path node its tails."""
    root: dict = {}
    for host, path, verdict in rules:
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault("", {})
        *whole, tail = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(None, {})[tail] = (host + path, verdict)
    return root


def longest_match(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits, by characters of host and path, and its verdict; of equal ones the one with the longer host."""
    best, node = None, trie
    segments = path.split("/")
    for label in reversed(host.split(".")):
        node = node.get(label) if label else None
        if node is None:
            break
        paths = node.get("")
        found = None
        for segment in segments:
            if paths is None:
                break
            fits = [t for t in paths.get(None, ()) if segment.startswith(t)]
            if fits:
                found = paths[None][max(fits, key=len)]
            paths = paths.get(segment)
        # hosts get longer on the way, so of equal rules the later one counts
        if found and (best is None or len(found[0]) >= len(best[0])):
            best = found
    return best


def judge_urls(df: DataFrame, rules: list[Rule], *, id_col: str, url_col: str = "url", default: str = "allow", max_trie_bytes: int = MAX_TRIE_BYTES) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row; ``rule`` is null where none fits.

    ``rules`` come as a list on the driver, so they are small; their bytes are checked,
    and beyond ``max_trie_bytes`` a join of host suffixes with the rules takes the
    place of the broadcast trie and gives the same rows. A rule needs a host. Null urls and urls without ``://`` have an empty host and path
    and get the default, as do hosts with an empty last label.
    """
    host, path = url_parts(F.col(url_col))
    parts = df.select(F.col(id_col), host.alias("host"), path.alias("path"))
    if not all(h for h, _, _ in rules):
        raise ValueError("a rule needs a host")
    lower = str.maketrans(UPPER, LOWER)
    rules = [(h, p, v) for (h, p), v in {(h.translate(lower), p): v for h, p, v in rules}.items()]
    if sum(len((h + p + v).encode()) for h, p, v in rules) > max_trie_bytes:
        return _judge_by_join(parts, rules, id_col, default)
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [longest_match(trie.value, h, p) for h, p in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return parts.mapInArrow(bounded(judge), f"`{id_col}` {kind}, host string, path string, rule string, verdict string")


def _judge_by_join(parts: DataFrame, rules: list[Rule], id_col: str, default: str) -> DataFrame:
    """The same by an equi-join of each distinct (host, path)'s host suffixes with the rules' hosts."""
    table = parts.sparkSession.createDataFrame(rules, "suffix string, rule_path string, rule_verdict string")
    urls = parts.select("host", "path").distinct()
    suffixes = urls.select("host", "path", F.expr("explode(transform(sequence(1, size(split(host, '[.]'))), i -> substring_index(host, '.', -i)))").alias("suffix"))
    hits = suffixes.join(table, "suffix").where(F.expr("startswith(path, rule_path) AND suffix <> ''"))
    best = hits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("suffix", "rule_path").alias("rule"), "rule_verdict"), F.struct((F.length("suffix") + F.length("rule_path")).alias("n"), F.length("suffix").alias("h"))).alias("best")
    )
    return parts.join(best, ["host", "path"], "left").select(
        id_col, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")
    )


#: The contract's rules.
RULES: list[Rule] = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op4(pages: DataFrame) -> DataFrame:
    return judge_urls(pages, RULES, id_col="page_id")


def op4_sql() -> str:
    """The same rows in DuckDB's SQL: every rule tried, the longest kept."""
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'" for h, p, _ in sorted(RULES, key=lambda r: (-len(r[0] + r[1]), -len(r[0])))
    )
    verdicts = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in RULES)
    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{pattern}', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '{pattern}', 2) AS path FROM pages),
r AS (SELECT *, CASE {fits} END AS rule FROM u)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE 'allow' END AS verdict FROM r"""
