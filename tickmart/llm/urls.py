"""URL filter: allow and block entries in a trie over reversed host labels and path segments."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries of one broadcast trie (some 100 bytes each); a longer list is tried trie by trie.
ENTRIES_PER_TRIE = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains ('' fits every host) where the path begins with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass
class PathNode:
    """Segments that must follow, and the rules that end here: the last, perhaps partial, segment."""

    below: dict[str, PathNode] = field(default_factory=dict)
    ends: list[tuple[str, str, bool]] = field(default_factory=list)


@dataclass
class HostNode:
    below: dict[str, HostNode] = field(default_factory=dict)
    paths: PathNode | None = None


def build_trie(rules: Iterable[Rule]) -> HostNode:
    """Of two equal entries that disagree the block entry counts."""
    root, last = HostNode(), {}
    for rule in rules:
        host = rule.host.translate(str.maketrans(UPPER, LOWER))
        last[host, rule.path] = last.get((host, rule.path), True) and rule.allow
    for (host, path), allow in last.items():
        node = root
        for label in reversed(host.split(".")) if host else ():
            node = node.below.setdefault(label, HostNode())
        node.paths = at = node.paths or PathNode()
        *whole, partial = path.split("/")
        for segment in whole:
            at = at.below.setdefault(segment, PathNode())
        at.ends.append((partial, host + path, allow))
        at.ends.sort(key=lambda end: -len(end[0]))
    return root


def longest_path(node: PathNode, segments: list[str]) -> tuple[str, bool] | None:
    found = None
    for segment in segments:
        for partial, name, allow in node.ends:
            if segment.startswith(partial):
                found = name, allow
                break
        if segment not in node.below:
            return found
        node = node.below[segment]
    return found


def longest_match(trie: HostNode, host: str, path: str) -> tuple[int, str, bool] | None:
    """The rule of the most host labels, and of those the longest path: (labels, name, allow)."""
    node, passed = trie, [(0, trie)]
    for depth, label in enumerate(reversed(host.split(".")) if host else (), 1):
        if (node := node.below.get(label)) is None:
            break
        passed.append((depth, node))
    segments = path.split("/")
    for depth, node in reversed(passed):
        if node.paths is not None and (found := longest_path(node.paths, segments)):
            return depth, *found
    return None


def url_host(url: Column) -> Column:
    """What follows the first '://' up to '/', '?', '#' or the end, A-Z in lower case; else ''."""
    host = F.regexp_extract(url, "^(?s:.*?)://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to '?', '#' or the end; else ''."""
    return F.coalesce(F.regexp_extract(url, "^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(
    pages: DataFrame, rules: list[Rule], default: str = "allow", id_column: str = "page_id", url: str = "url",
    per_trie: int = ENTRIES_PER_TRIE,
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule (null where none fits), verdict.

    The rule with the longest host that fits wins, of those the one with the longest path; hosts and
    paths of fitting rules are nested, so there are no ties. A null url, or one without '://', has
    an empty host and path; repeated rows are judged one by one; an empty rule list gives
    ``default`` everywhere. Other columns of ``pages`` are not read.

    The rules are configuration, held by the driver. A trie of ``per_trie`` entries at most is
    broadcast; a longer list is tried in that many rounds, all in one pass without a shuffle.
    """
    if id_column in ("host", "path", "best", "rule", "verdict"):
        raise ValueError(f"{id_column} is a column of the result")
    rows = pages.select(F.col(id_column), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rows = rows.withColumns({"best": F.lit(-1), "rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    ordered = sorted(set(rules), key=lambda r: (r.host, r.path, r.allow))
    groups = [ordered[i : i + per_trie] for i in range(0, len(ordered), per_trie)]
    for group in groups:
        trie = pages.sparkSession.sparkContext.broadcast(build_trie(group))

        def match(batches: Iterator[pa.RecordBatch], trie=trie) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns = {name: batch.column(name) for name in batch.schema.names}
                best, names, verdicts = (columns[c].to_pylist() for c in ("best", "rule", "verdict"))
                for i, (host, path) in enumerate(zip(columns["host"].to_pylist(), columns["path"].to_pylist(), strict=True)):
                    found = longest_match(trie.value, host, path)
                    if found is not None and better(found, (best[i], names[i], verdicts[i])):
                        best[i], names[i] = found[0], found[1]
                        verdicts[i] = "allow" if found[2] else "block"
                columns |= {"best": pa.array(best, pa.int32()), "rule": pa.array(names, pa.string()), "verdict": pa.array(verdicts, pa.string())}
                yield pa.RecordBatch.from_pydict(columns)

        rows = rows.mapInArrow(match, rows.schema)
    return rows.drop("best")


def better(found: tuple[int, str, bool], known: tuple[int, str | None, str]) -> bool:
    """More host labels, then the longer rule; of the same rule twice the block entry."""
    if found[0] != known[0] or known[1] is None:
        return found[0] > known[0]
    if len(found[1]) != len(known[1]):
        return len(found[1]) > len(known[1])
    return not found[2]
