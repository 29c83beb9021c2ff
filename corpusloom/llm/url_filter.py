"""URL filters: a sorted array of 64-bit digests, memory-mapped on each executor.

A rule is a host and a path prefix with a verdict. The index file holds the rules' xxh64 digests in sorted order, and
their full strings: a probe is a vectorised binary search over the digests, and a hit counts only when the stored
string equals the probed one, so that two strings of one digest are told apart.

The file is written to the shared folder, and Spark brings it to each executor's own disk (``SparkContext.addFile``),
also to one that replaces a lost executor. Rules are configuration: the file grows with them, never with the pages.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

from corpusloom.core.workspace import filesystem, new_path
from corpusloom.llm.batches import map_batches

_MAGIC = b"URLRULE1"
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Between host and path in a stored key; neither has it: a host ends before it and a path starts after.
_SEP = b"\n"
VERDICTS = ("block", "allow")


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    ends = [i for c in "?#" if (i := rest.find(c)) >= 0]
    rest = rest[: min(ends, default=len(rest))]
    host, slash, path = rest.partition("/")
    return host.encode().translate(_UPPER).decode(), slash + path


def build_index(rules: Iterable[tuple[str, str, str]], digest=xxhash.xxh64_intdigest) -> bytes:
    """The index file of (host, path, verdict) rules. Repeated rules: the last one holds."""
    held = {}
    for host, path, verdict in rules:
        if not host or verdict not in VERDICTS:
            raise ValueError(f"a rule needs a host and a verdict of {VERDICTS}: {(host, path, verdict)}")
        held[host.encode().translate(_UPPER) + _SEP + path.encode()] = VERDICTS.index(verdict)
    keys = sorted(held, key=lambda k: (digest(k), k))
    at = np.cumsum([0, *map(len, keys)]).astype("<i8")
    lengths = sorted({len(k) - k.index(_SEP) - 1 for k in keys})
    parts = [np.array([digest(k) for k in keys], "<u8"), at, np.array([held[k] for k in keys], "u1"), np.array(lengths, "<i8")]
    return _MAGIC + struct.pack("<qq", len(keys), len(lengths)) + b"".join(p.tobytes() for p in parts) + b"".join(keys)


class UrlIndex:
    """A mapped index file."""

    def __init__(self, path: str, digest=xxhash.xxh64_intdigest):
        self.digest = digest
        head = open(path, "rb").read(24)
        if head[:8] != _MAGIC:
            raise ValueError(f"{path} is no index of rules")
        n, k = struct.unpack("<qq", head[8:])
        at = 24

        def mapped(kind, count):
            nonlocal at
            out = np.memmap(path, kind, "r", at, (count,)) if count else np.empty(0, kind)
            at += out.nbytes
            return out

        self.digests, self.at, self.verdicts, self.lengths = mapped("<u8", n), mapped("<i8", n + 1), mapped("u1", n), mapped("<i8", k)
        self.strings = mapped("u1", int(self.at[-1]))

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The rule's number for each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        if not keys or not len(self.digests):
            return out
        d = np.fromiter(map(self.digest, keys), np.uint64, len(keys))
        lo, hi = np.searchsorted(self.digests, d, "left"), np.searchsorted(self.digests, d, "right")
        for i in np.flatnonzero(hi > lo):
            for r in range(lo[i], hi[i]):  # several only where digests collide
                if self.strings[self.at[r] : self.at[r + 1]].tobytes() == keys[i]:
                    out[i] = r
                    break
        return out

    def judge(self, urls: list[tuple[bytes, bytes]]) -> list[tuple[bytes, int] | None]:
        """(rule, verdict) of each (host, path), or None: the longest rule; at equal length that of the longer host."""
        keys, owners = [], []
        lengths = self.lengths.tolist()
        for i, (host, path) in enumerate(urls):
            while host:
                for n in lengths:
                    if n <= len(path):
                        keys.append(host + _SEP + path[:n])
                        owners.append(i)
                dot = host.find(b".")
                host = host[dot + 1 :] if dot >= 0 else b""
        best: list[tuple[bytes, int] | None] = [None] * len(urls)
        hits = self.find(keys)
        for j in np.flatnonzero(hits >= 0):
            i, k = owners[j], keys[j]
            # probes of one url come with hosts from long to short
            if best[i] is None or len(k) - 1 > len(best[i][0]):
                best[i] = (k.replace(_SEP, b"", 1), int(self.verdicts[hits[j]]))
        return best


#: This worker's mapped files, the last few by name.
_open: dict[str, UrlIndex] = {}


def opened(name: str) -> UrlIndex:
    if name not in _open:
        while len(_open) >= 8:
            _open.pop(next(iter(_open)))
        _open[name] = UrlIndex(SparkFiles.get(name))
    return _open[name]


def publish(spark: SparkSession, index: bytes) -> str:
    """Put the file into the shared folder, and on every executor; returns its name there."""
    name = f"url-rules-{uuid.uuid4().hex}.idx"
    path = f"{new_path(spark, 'rules')}/{name}"
    fs, at = filesystem(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(index))
    out.close()
    spark.sparkContext.addFile(str(at.toString()))
    return name


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: (<id_col>, host, path, rule, verdict, matched).

    A rule fits its host and all subdomains if the path starts with the rule's; the longest rule's verdict holds, else
    ``default``. Null urls and urls without ``://`` have an empty host and path, fit no rule and get the default.
    Repeated rows and ids, null ids too, are judged row by row; other columns are neither read nor returned. An empty
    table gives an empty result.
    """
    name = publish(pages.sparkSession, build_index(rules))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        urls = [split_url(u) for u in batch.column("u").to_pylist()]
        found = opened(name).judge([(h.encode(), p.encode()) for h, p in urls])
        return pa.record_batch(
            [
                batch.column("i"),
                pa.array([h for h, _ in urls], pa.string()),
                pa.array([p for _, p in urls], pa.string()),
                pa.array([f and f[0].decode() for f in found], pa.string()),
                pa.array([VERDICTS[f[1]] if f else default for f in found], pa.string()),
                pa.array([f is not None for f in found], pa.bool_()),
            ],
            names=[id_col, "host", "path", "rule", "verdict", "matched"],
        )

    kind = pages.schema[id_col].dataType.simpleString()
    return map_batches(pages, {"i": id_col, "u": url_col}, "u", work, f"`{id_col}` {kind}, host string, path string, rule string, verdict string, matched boolean")
