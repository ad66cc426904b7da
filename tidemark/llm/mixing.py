"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.storage import shared_dir

# Weights of the sources in order, repeating, and the most copies of a document.
WEIGHTS = (5, 2, 1)
MOST = 3
WORD = r"[^\x20\x09-\x0D]+"
#: Source tables up to this number of rows are broadcast.
FEW_SOURCES = 100_000
#: Bins of the rank key at each of two levels.
BINS = 4096

_SOURCE, _SIZE, _DRAW = "_mix_source", "_mix_size", "_mix_draw"
_MEASURES = "_mix_source_size", "_mix_target", "_mix_copies"


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """The rows with their source, number of words and a uniform draw in (0, 1).

    The draw comes from the id and the text, so it is the same in every run.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(text))
    bits = F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("bigint")
    return docs.select(
        "*",
        F.col(source_col).cast("string").alias(_SOURCE),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias(_SIZE),
        ((bits.cast("double") + 0.5) / float(1 << 52)).alias(_DRAW),
    )


def _numbered(sources: DataFrame) -> DataFrame:
    """``number`` from 0 by code point, null last; sorted by ranges, not in one task."""
    order = F.col(_SOURCE).asc_nulls_last()
    rows = (
        sources.repartitionByRange(order)
        .sortWithinPartitions(order)
        .withColumn("range", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id())
        .checkpoint()
    )
    starts = rows.groupBy("range").agg(F.min("row").alias("first"), F.count("*").alias("rows"))
    shift, before = [], 0
    for r in sorted(starts.collect()):  # one row per range
        shift += [F.lit(r["range"]), F.lit(before - r["first"])]
        before += r["rows"]
    moved = F.element_at(F.create_map(*shift), F.col("range")) if shift else F.lit(0)
    return rows.withColumn("number", F.col("row") + moved).drop("range", "row")


def _targets(sizes: DataFrame, weights: tuple, most: int) -> DataFrame:
    """Adds ``target``: the weight's share of all sizes, at most ``most`` times the own size.

    A source above its bound is held there and the rest shared anew by weight,
    until none is above. One row comes to the driver each time.
    """
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("number") % len(weights) + 1).cast("int"))
    sources = _numbered(sizes).withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    sources = sources.checkpoint()
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(1))).first()
    level = total[0] / total[1]
    while True:
        above = F.col("weight") * F.lit(level) > F.col("bound")
        held = sources.where(above).agg(
            F.coalesce(F.sum("bound"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))
        ).first()
        new = (total[0] - held[0]) / (total[1] - held[1])
        if new == level:
            break
        level = new
    held = F.when(above, F.col("bound").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return sources.select(_SOURCE, "source_size", held.alias("target"))


def _rates(small: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``_mix_rate``: expected copies per unit of weight, so that the words expected are the target.

    Documents whose weight would make more than ``MOST`` copies are held there
    and the rate of the others rises, the largest weights first. One row per
    source and weight is looked at.
    """
    classes = small.where(f"{_SIZE} > 0 AND _mix_weight > 0").groupBy(_SOURCE, "_mix_weight")
    classes = _by_source(classes.agg(F.sum(_SIZE).alias("words")), targets)
    order = Window.partitionBy(_SOURCE).orderBy(F.desc("_mix_weight"))
    mass = F.col("words") * F.col("_mix_weight")
    held = F.sum("words").over(order) - F.col("words")
    rest = F.sum(mass).over(Window.partitionBy(_SOURCE)) - F.sum(mass).over(order) + mass
    rate = (F.col(_MEASURES[1]) - float(MOST) * held) / rest
    classes = classes.withColumn("rate", rate).where(F.col("rate") * F.col("_mix_weight") <= float(MOST))
    rates = classes.groupBy(_SOURCE).agg(F.max_by("rate", "_mix_weight").alias("_mix_rate"))
    # Where all are held at the most, any rate does that is large enough.
    full = F.when(F.col(_MEASURES[1]) > 0, F.lit(1e300)).otherwise(F.lit(0.0))
    return _by_source(targets, rates, "left").withColumn("_mix_rate", F.coalesce("_mix_rate", full))


def _side(table: DataFrame) -> DataFrame:
    """A table with a row per source, as one side of a join."""
    return F.broadcast(table) if table.count() <= FEW_SOURCES else table.hint("merge")


def _by_source(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    table = table.withColumnRenamed(_SOURCE, "_mix_key")
    return rows.join(_side(table), F.col(_SOURCE).eqNullSafe(F.col("_mix_key")), how).drop("_mix_key")


def _ranked(rows: DataFrame, targets: DataFrame, weight: Column) -> DataFrame:
    """Adds whole copies, inclusion odds turned into a rank key in (0, 1), and its bins.

    Pareto: the key orders documents by the odds of their draw divided by the
    odds of their inclusion. Documents with no fraction to draw for have none.
    """
    rows = _by_source(rows, targets)
    expected = F.least(F.col("_mix_rate") * weight, F.lit(float(MOST)))
    rows = rows.withColumn("_mix_expected", expected)
    rows = rows.withColumn("_mix_whole", F.floor("_mix_expected"))
    share = F.col("_mix_expected") - F.col("_mix_whole")
    odds = (F.col(_DRAW) / (1 - F.col(_DRAW))) / (share / (1 - share))
    rows = rows.withColumn("_mix_odds", F.when(share > 0, odds))
    key = F.col("_mix_odds") / (1 + F.col("_mix_odds"))
    rows = rows.withColumn("_mix_key_", key)
    high = F.floor(F.col("_mix_key_") * BINS)
    low = F.floor(F.col("_mix_key_") * (BINS * BINS)) - high * BINS
    return rows.withColumn("_mix_high", high).withColumn("_mix_low", low)


def _crossing(bins: DataFrame, bin_: str, start: Column) -> DataFrame:
    """Per source the first bin whose words pass what is left, and the words before it."""
    order = Window.partitionBy(_SOURCE).orderBy(bin_)
    upto = start + F.sum("words").over(order)
    passed = bins.withColumn("upto", upto).where(F.col("upto") > F.col("_mix_rest"))
    first = F.min_by(F.struct(bin_, (F.col("upto") - F.col("words")).alias("before")), bin_)
    return passed.groupBy(_SOURCE).agg(first.alias("cut"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = WEIGHTS,
    seed: int = 0,
    weight_col: str | None = None,
    by_size: bool = True,
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows (their ``keep`` columns) with ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    A document's expected copies are its weight times its source's rate, three
    at most; the rate is such that the words expected are the source's target.
    The weight is ``weight_col`` if given (null and negative count as 0; in 64
    steps for each power of two), else the number of binary digits of its size,
    so that long documents are preferred a little; with ``by_size=False`` all weigh
    the same. The whole part is taken for certain. The fraction is the inclusion
    probability in a Pareto order sample: documents come in order of random odds
    over inclusion odds, and those whose middle word lies within what the
    source's target leaves are taken once more, so a source's words end within
    half a document of its target.

    The cut is found in two levels of bins of the rank key, from sums per source
    and bin; only the documents of one fine bin per source are put in exact
    order. Sums are combined before they are shuffled, so a hot source is no hot
    task. Null text has size 0, null source is a source of its own, sorted last.
    Repeated rows draw alike; rows equal in id and text are told apart only by
    the exact order. An empty table gives no rows. Columns of ``docs`` with the
    names above are replaced.
    """
    shared_dir(docs.sparkSession)
    names = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    rows = _measured(docs, id_col, text_col, source_col, seed)
    weight = F.length(F.bin(F.col(_SIZE))).cast("double") if by_size else F.lit(1.0)
    if weight_col:
        given = F.col(weight_col).cast("double")
        weight = F.when(given > 0, F.pow(F.lit(2.0), F.round(F.log2(given) * 64) / 64)).otherwise(F.lit(0.0))
    small = rows.select(
        F.col(id_col).alias("_mix_id"), _SOURCE, _SIZE, _DRAW, weight.alias("_mix_weight")
    ).checkpoint()
    sizes = small.groupBy(_SOURCE).agg(F.sum(_SIZE).alias("source_size"))
    targets = _targets(sizes, weights, MOST).select(
        _SOURCE, F.col("source_size").alias(_MEASURES[0]), F.col("target").alias(_MEASURES[1])
    )
    targets = _rates(small, targets.checkpoint()).checkpoint()

    ranked = _ranked(small, targets, F.col("_mix_weight"))
    whole = ranked.groupBy(_SOURCE, _MEASURES[1]).agg(
        F.sum(F.col("_mix_whole") * F.col(_SIZE)).alias("certain")
    )
    rest = whole.select(_SOURCE, (F.col(_MEASURES[1]) - F.col("certain")).alias("_mix_rest")).checkpoint()
    open_ = ranked.where(F.col("_mix_key_").isNotNull())
    words = F.sum(_SIZE).alias("words")
    bins = _by_source(open_.groupBy(_SOURCE, "_mix_high").agg(words), rest)
    high = _crossing(bins, "_mix_high", F.lit(0)).select(
        _SOURCE, F.col("cut._mix_high").alias("_cut_high"), F.col("cut.before").alias("_before_high")
    )
    high = high.checkpoint()
    inside = _by_source(open_, high).where(F.col("_mix_high") == F.col("_cut_high"))
    bins = _by_source(inside.groupBy(_SOURCE, "_mix_low", "_before_high").agg(words), rest)
    low = _crossing(bins, "_mix_low", F.col("_before_high")).select(
        _SOURCE, F.col("cut._mix_low").alias("_cut_low"), F.col("cut.before").alias("_before_low")
    )
    low = low.checkpoint()

    if set(keep) - {id_col}:
        final = _ranked(rows.withColumn("_mix_weight", weight), targets, F.col("_mix_weight"))
    else:
        final = ranked.withColumnRenamed("_mix_id", id_col)
    for table in (rest, high, low):
        final = _by_source(final, table, "left")
    cell = (F.col("_mix_high") == F.col("_cut_high")) & (F.col("_mix_low") == F.col("_cut_low"))
    cell = F.coalesce(cell, F.lit(False))
    # Past a source's last bin nothing is cut: all of its fractions are taken.
    before = F.col("_cut_high").isNull() | (F.col("_mix_high") < F.col("_cut_high"))
    same = (F.col("_mix_high") == F.col("_cut_high")) & (F.col("_mix_low") < F.col("_cut_low"))
    order = Window.partitionBy(_SOURCE).orderBy("_mix_key_", F.col(id_col)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    middle = F.col("_before_low") + F.sum(_SIZE).over(order) - F.col(_SIZE) / 2
    more = F.col("_mix_key_").isNotNull() & F.coalesce(before | same, F.lit(False))
    parts = (
        final.where(~cell).withColumn("_mix_more", more),
        final.where(cell).withColumn("_mix_more", middle <= F.col("_mix_rest")),
    )
    out = parts[0].unionByName(parts[1])
    copies = F.col("_mix_whole") + F.col("_mix_more").cast("bigint")
    return out.select(
        *keep,
        F.col(_SIZE).alias("size"),
        F.col(_MEASURES[0]).alias("source_size"),
        F.col(_MEASURES[1]).alias("target"),
        copies.alias("copies"),
        (copies * F.col(_SIZE)).alias("taken"),
    )
