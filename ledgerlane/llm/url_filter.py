"""URL filter rules in a sorted digest array, memory-mapped by the tasks that probe it.

The index is one file: the rules' XXH64 keys in ascending order, then the
offsets of their strings, their verdicts and the strings.  Spark hands every
executor one copy (``SparkContext.addFile``); tasks memory-map it, so a large
list costs page cache once for each machine and no heap.  A batch of URLs is
probed at once: all candidate keys by one vectorised binary search, and a key
that is present counts only if the stored rule string is the candidate's.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlane.llm.common import ascii_lower
from ledgerlane.llm.files import write_bytes
from ledgerlane.session import scratch

VERDICTS = ("allow", "block")


def _key(rule: str) -> int:
    return xxhash.xxh64_intdigest(rule.encode(errors="surrogatepass"))


def build_index(rules: Iterable[tuple[str, str]]) -> bytes:
    """The index of (verdict, 'host/path') rules.

    A rule named twice keeps its first verdict.  Layout, all little-endian
    64-bit: rule count, number of path lengths, path lengths, keys, offsets
    (count + 1), verdict numbers; then the strings' bytes.
    """
    seen: dict[str, int] = {}
    for verdict, rule in rules:
        if "/" not in rule:
            raise ValueError(f"rule {rule!r}: host/path expected")
        seen.setdefault(rule, VERDICTS.index(verdict))
    order = sorted(seen, key=lambda r: (_key(r), r))
    raw = [r.encode() for r in order]
    lengths = sorted({len(r) - r.index("/") for r in order})
    parts = (np.array([len(order), len(lengths), *lengths], np.uint64), np.array([_key(r) for r in order], np.uint64),
             np.cumsum([0, *map(len, raw)]).astype(np.uint64), np.array([seen[r] for r in order], np.uint64))
    return b"".join([*(p.astype("<u8").tobytes() for p in parts), *raw])


class DigestArray:
    """A memory-mapped index: probe keys, confirm strings."""

    def __init__(self, path: str):
        m = np.memmap(path, np.uint8, "r")
        n, k = (int(x) for x in m[:16].view("<u8"))
        at = 16 + 8 * k
        self.lengths = m[16:at].view("<u8").astype(int).tolist()
        self.keys = m[at:at + 8 * n].view("<u8")
        self.offsets = m[at + 8 * n:at + 8 * (2 * n + 1)].view("<u8")
        self.verdicts = m[at + 8 * (2 * n + 1):at + 8 * (3 * n + 1)].view("<u8")
        self.strings = m[at + 8 * (3 * n + 1):]

    def find(self, candidates: list[str]) -> list[int]:
        """The rule number of each candidate, -1 where no rule is that string."""
        if not candidates or not len(self.keys):
            return [-1] * len(candidates)
        want = np.fromiter(map(_key, candidates), np.uint64, len(candidates))
        at = np.searchsorted(self.keys, want)
        out = [-1] * len(candidates)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == want).tolist():
            raw = candidates[i].encode(errors="surrogatepass")
            j = int(at[i])
            while j < len(self.keys) and self.keys[j] == want[i]:  # equal keys stand together: a collision is told apart
                if self.strings[int(self.offsets[j]):int(self.offsets[j + 1])].tobytes() == raw:
                    out[i] = j
                    break
                j += 1
        return out

    def rule(self, j: int) -> tuple[str, str]:
        return (self.strings[int(self.offsets[j]):int(self.offsets[j + 1])].tobytes().decode(), VERDICTS[int(self.verdicts[j])])


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """Every rule that could fit: the host and its parent domains, with each path prefix as long as some rule's path."""
    prefixes = [path[:n] for n in lengths if n <= len(path)]
    while prefixes:
        for p in prefixes:
            yield host + p
        _, dot, host = host.partition(".")
        if not dot:
            return


@functools.lru_cache(maxsize=4)
def _opened(path: str) -> DigestArray:
    return DigestArray(path)


def _probe(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    index = _opened(SparkFiles.get(name))
    for batch in batches:
        hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
        flat: list[str] = []
        owner: list[int] = []
        for i, (h, p) in enumerate(zip(hosts, paths)):
            for c in candidates(h, p, index.lengths):
                flat.append(c)
                owner.append(i)
        best: list[int] = [-1] * len(hosts)
        for i, c, j in zip(owner, flat, index.find(flat)):
            if j >= 0 and (best[i] < 0 or _rank(c) > _rank(index.rule(best[i])[0])):
                best[i] = j
        rules = [index.rule(j) if j >= 0 else (None, None) for j in best]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([r for r, _ in rules], pa.string()), pa.array([v for _, v in rules], pa.string())],
            names=[*batch.schema.names, "rule", "verdict"])


def _rank(rule: str) -> tuple[int, int]:
    """The longest rule wins; of equally long ones the longer host."""
    return len(rule), rule.index("/")


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end."""
    rest = F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")
    has = F.coalesce(F.col(url).contains("://"), F.lit(False))
    host = F.when(has, F.regexp_extract(rest, "^([^/?#]*)", 1)).otherwise("")
    path = F.when(has, F.regexp_extract(rest, "^[^/?#]*(/[^?#]*)", 1)).otherwise("")
    return ascii_lower(host), path


def filter_urls(df: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Per row: ``id``, ``host``, ``path``, ``rule`` (null: none fits) and ``verdict`` (the rule's, else ``default``).

    A rule ``host/path`` fits its host and all subdomains where the URL's path
    starts with the rule's path; the longest wins, of equally long ones that
    with the longer host.  No shuffle: one scan of two columns, one copy of the
    index for each executor.

    Null URL or none with ``://``: empty host and path, no rule.  An empty
    rule list fits nothing.  Repeated rows are judged alike; an empty table
    gives no rows.  A URL of any length is read whole.  Other columns are not read.
    """
    spark: SparkSession = df.sparkSession
    name = f"rules-{uuid.uuid4().hex}.idx"
    shared = f"{scratch(spark, 'rules')}/{name}"
    write_bytes(shared, build_index(rules))
    spark.sparkContext.addFile(shared)  # each executor fetches its own copy
    host, path = host_and_path(url_col)
    src = df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    schema = f"id {df.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string"
    out = src.mapInArrow(lambda it: _probe(it, name), schema)
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
