"""Temperature mixing of sources, with DataFrame functions only.

A source's weight is its share of tokens to the power of an exponent: 1 keeps the natural mix, 0 makes all sources
alike. The exponent is bisected to meet a target entropy of the mix, or a limit on how often a source's documents are
repeated under a token budget. Each step of the search is one aggregation over the table of sources, whatever its
length; the driver sees sums, never the sources.

The weights are realised as block permutations. A source's documents are dealt into blocks by hash; an epoch goes
through the blocks, and through the documents of each block, in the order of hashes. A source whose share of the budget
is r times its tokens gives floor(r) whole epochs, and of one more epoch the documents up to the rest. Only sums per
block meet in one place, so a source with a third of all rows spreads over as many tasks as its blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.core.workspace import cut

#: Exponents tried in one aggregation; each pass narrows the interval to 1 / (GRID - 1).
GRID = 17
PASSES = 9
#: Weights are whole millionths: everything after them is integer arithmetic.
PARTS = 1_000_000_000_000
WORDS = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint")


def order_key(*parts: Column, seed: int) -> Column:
    """32 hex digits that order rows at random, the same on any engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))


def source_tokens(documents: DataFrame, source_col: str, text_col: str) -> DataFrame:
    """(source, tokens) of the sources that have tokens; the null source is one too."""
    rows = documents.select(F.col(f"`{source_col}`").alias("source"), token_count(F.col(f"`{text_col}`")).alias("n"))
    return rows.groupBy("source").agg(F.sum("n").alias("tokens")).where("tokens > 0")


def _sums(sources: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float, float, float]]:
    """For each exponent a, with shares p: (sum p^a, sum p^a ln p, max p^(a-1), min p^(a-1))."""
    p = F.col("tokens") / F.lit(float(total))
    cols = []
    for i, a in enumerate(exponents):
        w = F.exp(F.lit(float(a)) * F.log(p))
        epochs = F.exp(F.lit(float(a) - 1) * F.log(p))
        cols += [F.sum(w).alias(f"s{i}"), F.sum(w * F.log(p)).alias(f"l{i}"), F.max(epochs).alias(f"m{i}"), F.min(epochs).alias(f"n{i}")]
    r = sources.agg(*cols).first()
    return [(r[f"s{i}"], r[f"l{i}"], r[f"m{i}"], r[f"n{i}"]) for i in range(len(exponents))]


def entropy(s: float, sl: float, a: float) -> float:
    """Nats of the mix with weights p^a / s."""
    return math.log(s) - a * sl / s


def solve_exponent(sources: DataFrame, total: int, entropy_share: float | None, max_repeats: float | None, budget: int | None) -> float:
    """The exponent in [0, 1] nearest 0 that holds the entropy target (as a share of its maximum) and the limit.

    Entropy falls and repetition falls as the exponent rises, so each target is an interval's end: the entropy wants at
    least ``entropy_share`` of the way between the natural and the uniform mix, the limit at most ``max_repeats`` epochs
    of any source. Where they conflict, the limit rules.
    """

    def last_true(ok) -> float:
        """The largest exponent for which ok(sums, exponent) holds; it holds from 0 up to there."""
        low, high = 0.0, 1.0
        for _ in range(PASSES):
            grid = [low + (high - low) * i / (GRID - 1) for i in range(GRID)]
            good = [ok(s, a) for s, a in zip(_sums(sources, total, grid), grid, strict=True)]
            if good[-1]:
                return grid[-1]
            k = max((i for i, g in enumerate(good) if g), default=-1)
            if k < 0:
                return grid[0]
            low, high = grid[k], grid[k + 1]
        return low

    a = 0.0
    if entropy_share is not None:
        (s0, l0, *_), (s1, l1, *_) = _sums(sources, total, [0.0, 1.0])
        wanted = entropy(s1, l1, 1.0) + entropy_share * (entropy(s0, l0, 0.0) - entropy(s1, l1, 1.0))
        a = last_true(lambda s, x: entropy(s[0], s[1], x) >= wanted)
    if max_repeats is not None:

        def too_often(s: tuple, _: float) -> bool:
            # epochs of a source: p^a / s * budget / (p * total); without a budget, the least repeated has one
            return (s[2] / s[3] if budget is None else s[2] / s[0] * budget / total) > max_repeats

        if too_often(_sums(sources, total, [0.0])[0], 0.0):
            a = max(a, last_true(too_often))
    return a


def mix_sources(
    documents: DataFrame,
    budget_share: float | None = 1.0,
    entropy_share: float | None = 0.5,
    max_repeats: float | None = 4.0,
    seed: int = 7,
    block_rows: int = 2000,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: bool = False,
) -> DataFrame:
    """One row per use of a document: (<id_col>, source, n_tokens, epoch, block, position).

    Tokens are words. The budget is ``budget_share`` of all tokens; None is the least budget that leaves out no document:
    the source that the mix lowers most then comes once, and the others more often. position counts the tokens of the document's source
    before it in its epoch. With ``keep``, all columns of the input come instead, one row per use.

    The null source is a source like others. Documents without tokens (null and empty texts) weigh nothing: each comes
    once, in epoch 0. Rows repeated with id and text are separate documents. An empty table gives an empty result.
    """
    rows = documents.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), token_count(F.col(f"`{text_col}`")).alias("n"), F.md5(F.col(f"`{text_col}`")).alias("digest")
    )
    # the same rows are one row with a count: ties cannot come out differently when a task runs again
    rows = cut(rows.groupBy("id", "source", "n", "digest").agg(F.count("*").alias("rows")), "tokens")
    sources = cut(rows.groupBy("source").agg(F.sum(F.col("n") * F.col("rows")).alias("tokens"), F.sum("rows").alias("docs")).where("tokens > 0"), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = None if budget_share is None else math.floor(total * budget_share)
    a = solve_exponent(sources, total, entropy_share, max_repeats, budget) if total else 0.0
    s, _, _, lowest = _sums(sources, total, [a])[0] if total else (1.0, 0.0, 1.0, 1.0)
    whole = budget is None
    if whole:
        budget = math.ceil(total * s / lowest)
    share = F.round(F.exp(F.lit(a) * F.log(F.col("tokens") / F.lit(float(total or 1)))) / F.lit(s) * PARTS).cast("bigint")
    targets = sources.select(F.col("source").alias("of"), "tokens", F.ceil(F.col("docs") / block_rows).cast("bigint").alias("blocks"), F.floor(share.cast("decimal(20,0)") * F.lit(budget) / PARTS).cast("bigint").alias("target"))
    if whole:  # weights are rounded: that must not cost a document
        targets = targets.withColumn("target", F.greatest("target", "tokens"))

    # a block is dealt by one half of the key and walked through by the whole of it
    keyed = rows.join(F.broadcast(targets) if _few(sources) else targets, F.col("source").eqNullSafe(F.col("of")), "left")
    keyed = keyed.withColumn("key", order_key(F.col("id"), F.col("digest"), seed=seed))
    keyed = keyed.withColumn("block", F.when(F.col("n") > 0, F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint"), F.col("blocks"))))
    live = keyed.where("n > 0")
    per = live.groupBy("of", "block").agg(F.sum(F.col("n") * F.col("rows")).alias("t"))
    per = per.withColumn("turn", order_key(F.col("of"), F.col("block"), seed=seed))
    per = per.withColumn("before", F.coalesce(F.sum("t").over(Window.partitionBy("of").orderBy("turn", "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = Window.partitionBy("of", "block").orderBy("key", "id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    live = live.withColumn("own", F.coalesce(F.sum(F.col("n") * F.col("rows")).over(own), F.lit(0)))
    placed = live.alias("d").join(per.alias("b"), F.col("d.of").eqNullSafe(F.col("b.of")) & (F.col("d.block") == F.col("b.block")))
    first = F.col("b.before") + F.col("d.own")
    placed = placed.select("d.id", "d.source", "d.n", "d.digest", "d.rows", "d.block", "d.target", "d.tokens", first.alias("first"))
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    placed = placed.withColumn("position", F.col("first") + F.col("copy") * F.col("n"))
    # whole epochs, and one more for the documents that begin before the rest is used up
    times = F.floor(F.col("target") / F.col("tokens")) + F.when(F.col("position") < F.col("target") % F.col("tokens"), 1).otherwise(0)
    used = placed.withColumn("times", times).where("times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("times") - 1)))
    none = keyed.where("n = 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)))
    out = ["id", "source", "n", "digest", "epoch", "block", "position"]
    uses = used.select(*out).union(none.select("id", "source", "n", "digest", F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint")))
    if not keep:
        return uses.select(F.col("id").alias(id_col), "source", F.col("n").alias("n_tokens"), "epoch", "block", "position")
    # one text of each kind of row, times its uses
    counts = uses.groupBy("id", "source", "digest").agg(F.count("*").alias("uses"))
    held = documents.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(documents.columns)])
    at = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    spread = rows.select(F.col("id").alias("ri"), F.col("source").alias("rs"), F.col("digest").alias("rd"), "rows")
    counts = counts.join(spread, F.col("id").eqNullSafe(F.col("ri")) & F.col("source").eqNullSafe(F.col("rs")) & F.col("digest").eqNullSafe(F.col("rd"))).select("id", "source", "digest", "uses", "rows")
    back = held.join(counts, F.col(at[id_col]).eqNullSafe(F.col("id")) & F.col(at[source_col]).eqNullSafe(F.col("source")) & F.md5(F.col(at[text_col])).eqNullSafe(F.col("digest")))
    # of rows alike in id, source and text, each takes its part of the uses, in the order of a digest of all columns
    digest = F.sha2(F.to_json(F.struct(*at.values()), {"ignoreNullFields": "false"}), 256)
    nth = F.when(F.col("rows") == 1, F.lit(1)).otherwise(F.row_number().over(Window.partitionBy("id", "source", "digest").orderBy(digest)))
    back = back.withColumn("nth", nth) if rows.where("rows > 1").limit(1).count() else back.withColumn("nth", F.lit(1))
    each = F.floor(F.col("uses") / F.col("rows")) + F.when(F.col("nth") <= F.col("uses") % F.col("rows"), 1).otherwise(0)
    back = back.withColumn("each", each).where("each > 0").withColumn("use", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("each"))))
    return back.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(documents.columns)])


def _few(sources: DataFrame) -> bool:
    """Whether the table of sources may be broadcast: at most 10,000 rows of at most 200 characters."""
    n, longest = sources.agg(F.count("*"), F.max(F.length("source"))).first()
    return n <= 10_000 and (longest or 0) <= 200
