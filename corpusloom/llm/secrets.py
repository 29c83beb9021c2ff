"""Secret scans: patterns, and a character convolutional network over every other candidate and its context.

The patterns find assignments, access keys and long hexadecimal strings. What they leave of a run of key characters is a
candidate if it has 8 characters or more and is not made of plain words: the network sees its characters and those
around it, long ones in windows that overlap, and adds it as a finding where the calibrated probability of one of them
passes a threshold. The network is numpy: embedding, one convolution, the largest response of
each filter inside and outside the candidate, and a logistic layer.

It is trained on labelled findings, all of them: windows that the patterns flag, as they are, and whole and half without the word
or prefix that gave them away, against candidates that they do not flag and plain long words. Every distinct window of the first
two is learnt from, and every distinct plain word, in the text of the least checksum that has it. Candidates that look random may
be keys of a kind that no pattern knows, and teach nothing. The windows are dealt by hash into shards of about SHARD; in each of
ROUNDS rounds every shard trains a copy of the network where its last round ended, and the copies' mean is the next network. After
the last round every window has been seen. Means are of whole numbers, so that the network depends on the windows alone, not on
how rows are dealt.

One window of five is held back to calibrate probabilities, and the threshold is the highest that still recalls RECALL of all
findings held back: nothing else sets it. Logits are counted on a grid of 1 / GRID for that, rounded down, which changes neither
recall nor precision at the threshold. That precision is kept beside it, and a warning says so where it is below PRECISION.
"""

from __future__ import annotations

import hashlib
import re
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut_stage, drop
from corpusloom.llm.batches import release, releasing, slices

#: Fixed patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "model")
#: Some of these must occur, in either case, where ASSIGN matches.
_HINTS = ("passw", "secret", "token", "apikey", "api_key")
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{8,}")
#: Words, or words joined by signs: lower case, capitalised or upper case.
_PLAIN = re.compile(r"[+/_.=-]*(?:(?:[A-Z]?[a-z]+|[A-Z]+)[+/_.=-]*)?(?:[+/_.=-](?:[A-Z]?[a-z]+|[A-Z]+)[+/_.=-]*)*")
_MIXED = re.compile(r"[A-Za-z0-9]{12,}")
_WORD = re.compile(r"[A-Za-z]{8,}")

LEFT, BODY, RIGHT = 24, 48, 16
RECALL, PRECISION, GRID = 0.99, 0.9, 1024
#: Windows of a shard, rounds, the least steps of a round, windows of each label in a step, windows of a rare label in each shard.
SHARD, ROUNDS, STEPS, SHARES, RARE = 1 << 15, 8, 56, {1: 32, 0: 32, -1: 64}, 64
#: Windows that a task holds before it hands them on to the aggregation, which merges those of the whole task.
HELD = 1 << 14


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' findings, sorted: leftmost non-overlapping matches of each kind, then those too short dropped."""
    out = []
    low = text.lower()
    if any(h in low for h in _HINTS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    # both others are runs of key characters, so they lie in the long runs; in one of those, a match begins and ends as in the text
    for run in _RUN.finditer(text):
        a, z = run.span()
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text, a, z) if m.end() - m.start() >= 16]
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text, a, z) if m.end() - m.start() >= 32]
    return sorted(out)


def candidates(text: str, found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """What the findings (sorted) leave of runs of key characters, where it has 8 or more and is not made of plain words."""
    apart: list[list[int]] = []  # the findings where they touch as one
    for s, _, e in found:
        if apart and s <= apart[-1][1]:
            apart[-1][1] = max(apart[-1][1], e)
        else:
            apart.append([s, e])
    out, k = [], 0
    for m in _CANDIDATE.finditer(text):
        a, z = m.span()
        while k < len(apart) and apart[k][1] <= a:
            k += 1
        if _PLAIN.fullmatch(text, a, z):
            continue
        at = k
        while a < z:
            s, e = apart[at] if at < len(apart) and apart[at][0] < z else (z, z)
            if s - a >= 8 and not _PLAIN.fullmatch(text, a, s):
                out.append((a, s))
            a, at = e, at + 1
    return out


def looks_random(body: str) -> bool:
    """Whether letters and digits alternate, or cases do, in a stretch of 12 or more of them."""
    kind = lambda c: 0 if c.isdigit() else 1 if c.islower() else 2
    return any(sum(kind(a) != kind(b) for a, b in zip(m[0], m[0][1:])) >= 4 for m in _MIXED.finditer(body))  # noqa: B905


def parts(start: int, end: int) -> list[tuple[int, int]]:
    """The span, or stretches of BODY characters of a longer one that overlap by half and end with it."""
    if end - start <= BODY:
        return [(start, end)]
    return [(a, a + BODY) for a in [*range(start, end - BODY, BODY // 2), end - BODY]]


def window(text: str, start: int, end: int) -> str:
    """Context, body and context of a span, of fixed widths, padded with NUL; long bodies keep both ends."""
    body = text[start:end]
    if len(body) > BODY:
        body = body[: BODY // 2] + body[-(BODY - BODY // 2) :]
    left, right = text[max(0, start - LEFT) : start], text[end : end + RIGHT]
    return left.rjust(LEFT, "\0") + body.ljust(BODY, "\0") + right.ljust(RIGHT, "\0")


class CharNet:
    """Characters -> probability."""

    WIDTH, EMBED, FILTERS, SYMBOLS = 5, 12, 24, 130
    NAMES = ("embed", "kernel", "bias", "out", "out_bias")

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.embed = r.normal(0, 0.3, (self.SYMBOLS, self.EMBED))
        self.kernel = r.normal(0, (2 / (self.WIDTH * (self.EMBED + 1))) ** 0.5, (self.WIDTH * (self.EMBED + 1), self.FILTERS))
        self.bias = np.zeros(self.FILTERS)
        self.out = r.normal(0, 0.2, 2 * self.FILTERS)
        self.out_bias = np.zeros(1)
        self.scale, self.shift, self.threshold, self.recall, self.precision = 1.0, 0.0, 1.1, 0.0, 1.0
        inside = np.zeros(LEFT + BODY + RIGHT)
        inside[LEFT : LEFT + BODY] = 1
        self.inside = inside
        at = np.arange(len(inside) - self.WIDTH + 1)
        self.zone = (at >= LEFT - 2) & (at < LEFT + BODY - 2)

    @staticmethod
    def encode(windows: list[str]) -> np.ndarray:
        n = LEFT + BODY + RIGHT
        codes = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, n)
        return np.where(codes < 128, codes, 128).astype(np.int64)

    def _forward(self, x: np.ndarray):
        """(where each filter responds most, inside and outside; the filters; their responses there; logits) of encoded windows."""
        kernel, n = self.kernel.reshape(self.WIDTH, self.EMBED + 1, self.FILTERS), len(self.zone)
        act = np.empty((len(x), n, self.FILTERS))
        act[:] = self.bias + sum(self.inside[w : w + n, None] * kernel[w, -1] for w in range(self.WIDTH))
        for w in range(self.WIDTH):  # what each symbol adds at this place of the kernel
            act += (self.embed @ kernel[w, :-1])[x[:, w : w + n]]
        zone = np.flatnonzero(self.zone)
        a, z = zone[0], zone[-1] + 1
        rest = np.flatnonzero(~self.zone)
        top_in = a + act[:, a:z].argmax(axis=1)
        top_out = rest[np.concatenate([act[:, :a], act[:, z:]], axis=1).argmax(axis=1)]
        pick = np.concatenate([top_in, top_out], axis=1)
        f = np.tile(np.arange(self.FILTERS), 2)
        h = np.maximum(act[np.arange(len(x))[:, None], pick, f[None, :]], 0)
        return pick, f, h, h @ self.out + self.out_bias[0]

    @classmethod
    def codes(cls, windows: list[str]) -> np.ndarray:
        """encode in bytes, some thousand windows at a time: it takes eight times the memory."""
        return np.concatenate([np.empty((0, LEFT + BODY + RIGHT), np.uint8), *(cls.encode(windows[i : i + 4096]).astype(np.uint8) for i in range(0, len(windows), 4096))])

    def logits(self, windows: list[str]) -> np.ndarray:
        return np.concatenate([self._forward(self.encode(windows[i : i + 256]))[-1] for i in range(0, len(windows), 256)]) if windows else np.empty(0)

    def scaled(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -40, 40)))

    def probability(self, windows: list[str]) -> np.ndarray:
        return self.scaled(self.logits(windows))

    def train(self, windows: list[str], labels: np.ndarray, epochs: int = 8, rate: float = 3e-3, batch: int = 64, seed: int = 5) -> None:
        r = np.random.default_rng(seed)
        x, y = self.encode(windows), labels.astype(float)
        weigh = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
        moments = self.moments()
        for _ in range(epochs):
            order = r.permutation(len(x))
            for i in range(0, len(x), batch):
                k = order[i : i + batch]
                self.descend(x[k], y[k], weigh[k] / len(k), moments, rate)

    def moments(self) -> dict:
        """What Adam's steps keep from one to the next."""
        return {"step": 0} | {n: (np.zeros_like(getattr(self, n)), np.zeros_like(getattr(self, n))) for n in self.NAMES}

    def descend(self, x: np.ndarray, y: np.ndarray, weigh: np.ndarray, moments: dict, rate: float = 3e-3) -> None:
        """One step of Adam on encoded windows, each of which weighs as given."""
        pick, f, h, z = self._forward(x)
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * weigh
        g_h = d[:, None] * self.out * (h > 0)
        at = pick[:, :, None] + np.arange(self.WIDTH)
        # what reaches each place of each filter from each symbol
        cell = (np.arange(self.WIDTH) * self.FILTERS + f[:, None]) * self.SYMBOLS + x[np.arange(len(x))[:, None, None], at]
        got = np.bincount(cell.ravel(), np.repeat(g_h.ravel(), self.WIDTH), self.WIDTH * self.FILTERS * self.SYMBOLS).reshape(-1, self.SYMBOLS)
        kernel = self.kernel.reshape(self.WIDTH, self.EMBED + 1, self.FILTERS)
        g_kernel = np.empty_like(kernel)
        g_kernel[:, :-1] = (got @ self.embed).reshape(self.WIDTH, self.FILTERS, self.EMBED).transpose(0, 2, 1)
        g_kernel[:, -1] = np.einsum("nk,nkw->kw", g_h, self.inside[at]).reshape(2, self.FILTERS, self.WIDTH).sum(axis=0).T
        g_embed = got.T @ kernel[:, :-1].transpose(0, 2, 1).reshape(-1, self.EMBED)
        g_bias = g_h.sum(axis=0).reshape(2, self.FILTERS).sum(axis=0)
        g = {"out": d @ h, "out_bias": np.array([d.sum()]), "kernel": g_kernel.reshape(self.kernel.shape), "bias": g_bias, "embed": g_embed}
        moments["step"] = step = moments["step"] + 1
        for n in self.NAMES:
            m, v = moments[n]
            moments[n] = m, v = 0.9 * m + 0.1 * g[n], 0.999 * v + 0.001 * g[n] ** 2
            setattr(self, n, getattr(self, n) - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8))

    def train_shard(self, codes: np.ndarray, labels: np.ndarray, turn: int, seed: int) -> None:
        """The steps of round ``turn`` on a shard: each takes a share of every label, where the last one ended; over all rounds
        each window is taken. Findings weigh as much as all others, and both labels of the others alike."""
        order = np.random.default_rng((5, seed)).permutation(len(labels))
        share = {k: (order[labels[order] == k], n) for k, n in SHARES.items() if (labels == k).any()}
        steps = max([STEPS, *(-(-len(at) // (n * ROUNDS)) for at, n in share.values())])
        y = np.concatenate([np.full(n, float(k > 0)) for k, (_, n) in share.items()])
        others = sum(k <= 0 for k in share)
        weigh = np.concatenate([np.full(n, 0.5 / n if k > 0 else 0.5 / n / others) for k, (_, n) in share.items()])
        moments = self.moments()
        for i in range(turn * steps, (turn + 1) * steps):
            k = np.concatenate([at[np.arange(i * n, (i + 1) * n) % len(at)] for at, n in share.values()])
            self.descend(codes[k].astype(np.int64), y, weigh, moments)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for n in self.NAMES:
            old = getattr(self, n)
            setattr(self, n, flat[at : at + old.size].reshape(old.shape))
            at += old.size

    def calibrate(self, windows: list[str], labels: np.ndarray, recall: float = RECALL) -> None:
        """Platt's scaling by Newton steps, with his smoothed targets; then the threshold, and recall and precision there.

        Without findings, or with nothing but findings, there is nothing to tell apart: no probability passes.
        """
        self.settle(self.logits(windows), labels.astype(float), np.ones(len(labels)), recall)

    def settle(self, z: np.ndarray, y: np.ndarray, n: np.ndarray, recall: float = RECALL) -> None:
        """calibrate from logits, labels and how often each pair of them occurs."""
        n1, n0 = (n * y).sum(), (n * (1 - y)).sum()
        if not n1 or not n0:
            self.threshold, self.recall, self.precision = 1.1, 0.0, 1.0
            return
        t = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        w = np.array([1.0, 0.0])
        a = np.column_stack([z, np.ones(len(z))])
        loss = lambda w: n @ (np.logaddexp(0, a @ w) - t * (a @ w)) + 5e-4 * ((w - [1.0, 0.0]) ** 2).sum()
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -40, 40)))
            h = a.T @ (a * (n * p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
            step = np.linalg.solve(h, a.T @ (n * (p - t)) + 1e-3 * (w - [1.0, 0.0]))
            step = np.clip(step, -2, 2)
            # full steps may swing to and fro where one label is rare: halved until the loss falls
            while np.abs(step).max() >= 1e-9 and loss(w - step) > loss(w):
                step = step / 2
            if np.abs(step).max() < 1e-9:
                break
            w = w - step
        self.scale, self.shift = float(w[0]), float(w[1])
        p = self.scaled(z)
        order = np.flatnonzero(y > 0)[np.argsort(p[y > 0], kind="stable")]
        self.threshold = float(p[order][np.searchsorted(np.cumsum(n[order]), int((1 - recall) * n1), side="right")])
        over = p >= self.threshold
        self.recall, self.precision = float((n * y)[over].sum() / n1), float((n * y)[over].sum() / n[over].sum())
        if self.precision < PRECISION:
            warnings.warn(f"secret scan: at a recall of {self.recall:.2f} the network's precision is {self.precision:.2f}", stacklevel=2)


def plain_words(text: str, apart: list[tuple[int, int]]) -> Iterator[re.Match]:
    """The long plain words of a text that lie apart from the spans given (sorted)."""
    k = 0
    for m in _WORD.finditer(text):
        while k < len(apart) and apart[k][1] <= m.start():
            k += 1
        if k == len(apart) or m.end() <= apart[k][0]:
            yield m


def labelled_windows(documents: DataFrame, text_col: str) -> DataFrame:
    """(w, label, held): every distinct window with label 1 (the patterns' findings) or 0 (other candidates), and one of
    every distinct long plain word with -1: that of the text of the least checksum. held is true for one of five."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[str, int] = {}
        words: dict[str, str] = {}  # checksum of the text and window

        def flush() -> pa.RecordBatch:
            w = pa.array([*("0" * 8 + w for w in got), *words.values()], pa.string())
            out = pa.record_batch([w, pa.array([*got.values(), *[-1] * len(words)], pa.int32())], names=["w", "label"])
            got.clear()
            words.clear()
            return out

        for whole in batches:
            for batch in slices(whole, "t"):
                for text in batch.column("t").to_pylist():
                    spans = base_spans(text)
                    for s, kind, e in spans:
                        # as it is; and the value alone, whole and half, in a text without the word or prefix that gave it away
                        value = ASSIGN.match(text, s).start(2) if kind == 0 else s + 4 if kind == 1 else s
                        for a, z in parts(s, e):
                            got[window(text, a, z)] = 1
                        right = text[e : e + RIGHT + 1].lstrip("\"'")
                        for body in {text[value:e], text[value : max(value + 8, (value + e) // 2)]}:
                            near = text[max(0, s - LEFT) : s] + body + right
                            for a, z in parts(min(s, LEFT), min(s, LEFT) + len(body)):
                                got[window(near, a, z)] = 1
                    others = candidates(text, spans)
                    for s, e in others:
                        if not looks_random(text[s:e]):
                            for a, z in parts(s, e):
                                got.setdefault(window(text, a, z), 0)
                    apart = sorted([*((s, e) for s, _, e in spans), *others])
                    h = f"{zlib.crc32(text.encode()):08x}"
                    for m in plain_words(text, apart):
                        old = words.get(m[0])
                        if old is None or h <= old[:8]:
                            new = h + window(text, *m.span())
                            words[m[0]] = new if old is None else min(old, new)
                    if len(got) + len(words) >= HELD:
                        yield flush()
        yield flush()

    found = documents.select(F.col(f"`{text_col}`").alias("t")).where("t is not null").mapInArrow(releasing(run), "w string, label int")
    plain = F.col("label") < 0
    # a word is what the network sees of it
    key = F.when(plain, F.substring("w", 8 + LEFT + 1, BODY)).otherwise(F.col("w"))
    one = found.groupBy(plain.alias("plain"), key.alias("key")).agg(F.min(F.struct((-F.col("label")).alias("no"), "w")).alias("one"))
    one = one.select(F.substring("one.w", 9, LEFT + BODY + RIGHT).alias("w"), (-F.col("one.no")).alias("label"))
    return one.withColumn("held", F.pmod(F.xxhash64("w"), F.lit(5)) == 0)


def shards(windows: DataFrame, counts: dict[int, int], size: int) -> DataFrame:
    """(shard, codes, labels): a row for about ``size`` windows. Where a label has fewer than RARE for each shard, each of its windows
    goes to as many shards as make up for that."""
    n = max(1, -(-sum(counts.values()) // size))
    times = {k: min(n, max(1, -(-RARE * n // c))) for k, c in counts.items()}

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        both = sorted(zip(rows.column("w").to_pylist(), rows.column("label").to_pylist(), strict=True))
        codes = CharNet.codes([w for w, _ in both]).tobytes()
        out = pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "codes": pa.array([codes], pa.binary()), "labels": pa.array([np.array([k for _, k in both], np.int8).tobytes()], pa.binary())})
        del both, codes
        release()
        return out

    copies = F.coalesce(*[F.when(F.col("label") == k, F.lit(t)) for k, t in times.items()])
    dealt = windows.select("w", "label", F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy"))
    dealt = dealt.select("w", "label", F.pmod(F.xxhash64("w", F.lit(1)) + F.col("copy"), F.lit(n).cast("bigint")).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(pack, "shard bigint, codes binary, labels binary")


def train_round(net: CharNet, table: DataFrame, turn: int) -> None:
    """net becomes the mean of the copies that the shards have trained, in units of 2 ** -40."""
    held = table.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = CharNet()
                own.put(held.value.flat())
                labels = np.frombuffer(row["labels"], np.int8)
                own.train_shard(np.frombuffer(row["codes"], np.uint8).reshape(len(labels), -1), labels, turn, row["shard"])
                yield pa.record_batch([pa.array([np.rint(own.flat() * 2.0**40).astype(np.int64)], pa.list_(pa.int64()))], names=["p"])

    each = table.mapInArrow(releasing(run), "p array<bigint>").select(F.posexplode("p").alias("at", "x"))
    rows = sorted(each.groupBy("at").agg(F.sum("x"), F.count("x")).collect())
    net.put(np.array([r[1] / r[2] for r in rows]) * 2.0**-40)
    held.destroy()


def held_logits(net: CharNet, windows: DataFrame) -> list[tuple[int, int, int]]:
    """(logit in units of 1 / GRID, rounded down; whether a finding; how many windows)."""
    held = windows.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.floor(held.value.logits(batch.column("w").to_pylist()) * GRID).astype(np.int64)
            yield pa.record_batch([pa.array(z), batch.column("label")], names=["z", "label"])

    cells = windows.select("w", (F.col("label") > 0).cast("int").alias("label")).mapInArrow(releasing(run), "z bigint, label int")
    rows = sorted(tuple(r) for r in cells.groupBy("z", "label").count().collect())
    held.destroy()
    return rows


def train_on(documents: DataFrame, text_col: str = "text", shard: int = SHARD) -> CharNet:
    """A network trained on four of five of all windows of the documents, calibrated on all others."""
    spark, net = documents.sparkSession, CharNet()
    windows, path = cut_stage(spark, lambda: labelled_windows(documents, text_col), "secret-windows")
    counts = {(r["held"], r["label"]): r["count"] for r in windows.groupBy("held", "label").count().collect()}
    taught = {k: n for (held, k), n in counts.items() if not held}
    if 1 in taught and len(taught) > 1:
        table, at = cut_stage(spark, lambda: shards(windows.where("not held"), taught, shard), "secret-shards")
        for turn in range(ROUNDS):
            train_round(net, table, turn)
        drop(spark, at)
        if cells := held_logits(net, windows.where("held")):
            z, y, n = np.array(cells, float).T
            net.settle(z / GRID, y, n)
    drop(spark, path)
    return net


def fit(labelled: list[tuple[str, int]]) -> CharNet:
    """A network trained on four of five of the windows at hand, calibrated on the fifth; train_on does it for a table's."""
    net = CharNet()
    data = sorted((hashlib.sha256(w.encode("utf-8", "surrogatepass")).hexdigest(), w, int(label > 0)) for w, label in labelled)
    held = [d for i, d in enumerate(data) if i % 5 == 0]
    rest = [d for i, d in enumerate(data) if i % 5]
    if any(d[2] for d in rest) and not all(d[2] for d in rest):
        net.train([d[1] for d in rest], np.array([d[2] for d in rest]))
    net.calibrate([d[1] for d in held], np.array([d[2] for d in held]))
    return net


def scan_text(text: str, net: CharNet | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(the patterns' findings, all findings) of a text, each (start, kind, end) in code points."""
    base = base_spans(text)
    more = []
    if net is not None and net.threshold <= 1 and (near := candidates(text, base)):
        own = [(c, part) for c in near for part in parts(*c)]
        p = net.probability([window(text, *part) for _, part in own])
        more = [(s, 3, e) for s, e in sorted({c for (c, _), x in zip(own, p, strict=True) if x >= net.threshold})]
    return base, sorted(base + more)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(documents: DataFrame, net: CharNet | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: (<id_col>, n_assign, n_access, n_hex, n_model, base_spans, spans).

    Spans are kind:start:end in code points, end exclusive, joined by commas in order of start and kind; base_spans are
    those of the patterns. Without ``net``, one is trained on the documents. Null texts are empty, and empty ones have no
    spans. Texts are read whole, however long, in time that grows with their length. Ids, null or repeated ones too, are
    carried along row by row; other columns are not read. Spans that start together stand in the order of KINDS. An
    empty table gives an empty result.
    """
    held = documents.sparkSession.sparkContext.broadcast(net or train_on(documents, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "t"):
                got = [scan_text(t or "", held.value) for t in batch.column("t").to_pylist()]
                count = [pa.array([sum(k == kind for _, k, _ in g[1]) for g in got], pa.int64()) for kind in range(4)]
                yield pa.record_batch([batch.column("i"), *count, pa.array([joined(b) for b, _ in got]), pa.array([joined(a) for _, a in got])], names=[id_col, "n_assign", "n_access", "n_hex", "n_model", "base_spans", "spans"])

    kind = documents.schema[id_col].dataType.simpleString()
    read = documents.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))
    return read.mapInArrow(releasing(run), f"`{id_col}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, n_model bigint, base_spans string, spans string")


def redact_text(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """text with each stretch of findings that overlap put as one mark."""
    out, at = [], 0
    for s, _, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(documents: DataFrame, net: CharNet | None = None, text_col: str = "text", length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All columns and rows of documents, the findings in their texts put as ``mark``; length_col, if there, follows.

    Null texts stay null. Texts without a finding, repeated rows and all other columns, whatever their names, stay as
    they are. Texts are read whole, some megabytes at a time. An empty table gives an empty result.
    """
    held = documents.sparkSession.sparkContext.broadcast(net or train_on(documents, text_col))
    columns = documents.columns
    at = columns.index(text_col)
    long = columns.index(length_col) if length_col in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, columns[at])):
            old = batch.column(at).to_pylist()
            new = [t if t is None else redact_text(t, scan_text(t, held.value)[1], mark) for t in old]
            cols = list(batch.columns)
            cols[at] = pa.array(new, batch.column(at).type)
            if long is not None:
                was = batch.column(long).to_pylist()
                cols[long] = pa.array([w if a == b or b is None else len(b) for w, a, b in zip(was, old, new, strict=True)], batch.column(long).type)
            yield pa.record_batch(cols, schema=batch.schema)

    return documents.mapInArrow(releasing(run), documents.schema)
