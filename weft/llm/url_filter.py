"""URL filter: a broadcast trie over reversed host labels and path segments; the longest match wins."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest rule table that is broadcast, in entries; a larger one is refused rather than sent.
MAX_RULES = 1_000_000


def split_rule(rule: str) -> tuple[str, str]:
    """``host/path`` to (host, path with its leading slash); the host is lower-cased (A-Z)."""
    host, slash, path = rule.partition("/")
    return host.encode().lower().decode(), slash + path


def build_trie(rules) -> dict:
    """Nested dicts: host labels from the right, then whole path segments, then an open last segment.

    A node holds ``"labels"`` (next host label), ``"segments"`` (next whole path segment, ended by a
    slash) and ``"ends"``: open last segments in order of falling length, each with (rule, verdict).
    Of two entries for the same rule, block wins.
    """
    root: dict = {}
    for rule, verdict in rules:
        host, path = split_rule(rule)
        node = root
        for label in reversed(host.split(".")):
            node = node.setdefault("labels", {}).setdefault(label, {})
        if path:
            *whole, last = path[1:].split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault("segments", {}).setdefault(segment, {})
        else:
            node, last = node.setdefault("paths", {}), None
        ends = node.setdefault("ends", {})
        if ends.get(last, ("", ""))[1] != "block":
            ends[last] = (rule, verdict)
    return root


def longest(trie: dict, host: str, path: str):
    """(rule, verdict) of the entry with the longest text that fits, or None.

    An entry fits its host and all subdomains, if the path starts with the entry's. Ties in length
    go to the deeper host.
    """
    best, size, node = None, -1, trie
    for label in [None, *reversed(host.split("."))]:
        if label is not None:
            node = node.get("labels", {}).get(label)
            if node is None:
                break
        at = node.get("paths")
        if at is None:
            continue
        if None in at.get("ends", {}) and len(at["ends"][None][0]) >= size:
            best, size = at["ends"][None], len(at["ends"][None][0])
        if not path.startswith("/"):
            continue
        segments = path[1:].split("/")
        for i, segment in enumerate(segments):
            ends = at.get("ends", {})
            rest = segment if i == len(segments) - 1 else segment + "/"
            for k in range(len(rest), -1, -1):
                hit = ends.get(rest[:k])
                if hit:
                    if len(hit[0]) >= size:
                        best, size = hit, len(hit[0])
                    break
            at = at.get("segments", {}).get(segment) if i < len(segments) - 1 else None
            if at is None:
                break
    return best


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path as the contract cuts them; without ``://`` both are empty."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"), slash + path


def filter_urls(df: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row's URL by ``rules`` ((``host/path``, ``allow`` or ``block``) entries).

    Returns one row per input row, repeated rows included: id, host, path, rule (null if none fits)
    and verdict (``default`` where no rule fits). A null or empty URL, or one without ``://``, has
    an empty host and path and takes the default. Other columns, whatever their names, are not
    read. An empty table gives an empty result. The trie is broadcast; its size is that of the rule
    list, which is refused over MAX_RULES entries.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    trie = df.sparkSession.sparkContext.broadcast(build_trie(rules))
    src = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))

    def judge(batches):
        tree = trie.value
        for b in batches:
            host, path, rule, verdict = [], [], [], []
            for url in b.column(1).to_pylist():
                h, p = split_url(url)
                hit = longest(tree, h, p)
                host.append(h)
                path.append(p)
                rule.append(hit and hit[0])
                verdict.append(hit[1] if hit else default)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x, pa.string()) for x in (host, path, rule, verdict))], ["id", "host", "path", "rule", "verdict"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(judge, f"id {kind}, host string, path string, rule string, verdict string").withColumnRenamed("id", id_col)
