"""Signal alignment: long-form samples of unequal rates to one row per base sample.

The base signal's sample count is the row count of a flight. A faster signal is averaged over runs
of samples, a slower one repeats each sample, a text signal contributes one value to all rows, and
a flight whose signals do not come out at the base length is rejected as a whole.

Everything is keyed by flight and a stretch of the sample index, never by the flight alone, so a
flight (or one signal of it) that holds most of the rows is still spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightloom.functions.columns import clean_text, column_for_signal, lookup
from flightloom.schemas import BASE_SIGNAL, SIGNAL_COLUMNS, SILVER
from flightloom.session import BROADCAST_ROWS, fits_broadcast, settle

KEY = "flight_id"
# The signal columns of an aligned row. A caller may add columns for further signals.
SILVER_SIGNALS = {
    f.name: f.dataType.simpleString() for f in SILVER.fields if f.name in SIGNAL_COLUMNS.values()
}
INPUT_BLOCK = 1 << 18  # samples of one signal that share a join key
OUTPUT_SLICE = 1 << 16  # rows of one flight that share a pivot task


def rename_signals(signals: DataFrame) -> DataFrame:
    return signals.withColumn("column_name", column_for_signal(F.col("param")))


def rename_columns(wide: DataFrame) -> DataFrame:
    """The same for a wide frame with one column per recorded signal."""
    return wide.withColumnsRenamed(SIGNAL_COLUMNS)


def clean_strings(signals: DataFrame) -> DataFrame:
    return signals.filter(F.col("str_value").isNotNull()).withColumn(
        "clean_value", clean_text(F.col("str_value"))
    )


def signal_profile(signals: DataFrame, key: str = KEY) -> DataFrame:
    """One row per flight and signal: lengths, how it is resampled, and whether it fits.

    ``signal_kind`` is text, down, up, pass or invalid; ``factor`` samples make one row and each
    sample fills ``repeat`` rows; ``out_len`` is the resulting length.
    """
    # A bit per sample, 64 samples to a word: all sums here are mergeable and hashed. Text is grouped
    # by value: max over strings needs a sort, so it only sees what is left after that.
    bit = F.expr("shiftleft(1L, CAST(pmod(idx, 64) AS int))")
    by_word = signals.groupBy(
        key, "param", clean_text(F.col("str_value")).alias("text_value"), F.expr("idx div 64").alias("word")
    ).agg(
        F.count("idx").alias("n"),
        F.count("num_value").alias("n_num"),
        F.count("str_value").alias("n_text"),
        F.min("idx").alias("first_idx"),
        F.max("idx").alias("last_idx"),
        F.bit_or(bit).alias("bits"),
    )
    totals = [F.sum(c).alias(c) for c in ("n", "n_num", "n_text")]
    by_value = by_word.groupBy(key, "param", "text_value").agg(
        *totals,
        F.min("first_idx").alias("first_idx"),
        F.max("last_idx").alias("last_idx"),
        F.sum(F.bit_count("bits")).alias("n_distinct"),
    )
    sized = by_value.groupBy(key, "param").agg(
        *totals,
        F.sum("n_distinct").alias("n_distinct"),
        F.min("first_idx").alias("first_idx"),
        F.max("last_idx").alias("last_idx"),
        F.max("text_value").alias("text_value"),
    )
    flight = Window.partitionBy(key)
    column = Window.partitionBy(key, "column_name")
    base_len = F.max(F.when(F.col("param") == BASE_SIGNAL, F.col("n"))).over(flight)
    ratio = F.when(F.col("base_len") > 0, F.col("n") / F.col("base_len"))
    kind = (
        F.when(F.col("n_text") > 0, "text")
        .when((F.col("n_num") == 0) & (F.col("n") > 0), "invalid")
        .when(F.col("ratio") > 1, "down")
        .when((F.col("ratio") > 0) & (F.col("ratio") < 1), "up")
        .otherwise("pass")
    )
    factor = F.when(F.col("signal_kind") == "down", F.floor("ratio")).otherwise(1)
    # half to even: 2.5 repeats twice
    repeat = F.when(F.col("signal_kind") == "up", F.bround(1 / F.col("ratio")).cast("long"))
    out_len = F.when(F.col("signal_kind") == "text", F.col("base_len")).when(
        F.col("signal_kind") != "invalid",
        F.least(F.col("base_len"), F.expr("n div factor") * F.col("repeat")),
    )
    return (
        sized.withColumn("column_name", column_for_signal(F.col("param")))
        .withColumn("base_len", base_len)
        # two signals for one column: the later name wins
        .withColumn("used", F.col("param") == F.max("param").over(column))
        .withColumn("ratio", ratio)
        .withColumn("signal_kind", kind)
        .withColumn("factor", factor.cast("long"))
        .withColumn("repeat", F.coalesce(repeat, F.lit(1).cast("long")))
        .withColumn("out_len", out_len)
    )


def _fault(columns: dict[str, str]) -> Column:
    """Why a profile row makes its flight fail; NULL if it does not."""
    numeric = [c for c, kind in columns.items() if kind != "string"]
    castable = F.col("text_value").try_cast("double").isNotNull()
    return (
        F.when(F.coalesce(F.col("base_len"), F.lit(0)) == 0, f"no samples of {BASE_SIGNAL}")
        .when(~F.col("used"), None)
        .when((F.col("n") == 0), F.concat(F.lit("no samples of "), F.col("param")))
        .when(F.col("n_distinct") != F.col("n"), F.concat(F.lit("repeated samples in "), F.col("param")))
        .when(
            (F.col("last_idx") != F.col("n") - 1) | (F.col("first_idx") != 0),
            F.concat(F.lit("gaps in "), F.col("param")),
        )
        .when(
            F.col("signal_kind") == "invalid",
            F.concat(F.lit("neither numbers nor text in "), F.col("param")),
        )
        .when(
            (F.col("signal_kind") == "text")
            & F.col("column_name").isin(*numeric)
            & ~castable,
            F.concat(F.lit("text in numeric signal "), F.col("param")),
        )
        .when(
            F.col("out_len") != F.col("base_len"),
            F.concat_ws(
                " ", F.col("param"), F.lit("fills"), F.col("out_len"), F.lit("of"),
                F.col("base_len"), F.lit("rows"),
            ),
        )
    )


def flight_frames(
    profile: DataFrame, key: str = KEY, columns: dict[str, str] = SILVER_SIGNALS
) -> DataFrame:
    """One row per flight: length, column count, text values, and the fault if it has one."""
    text = "if(used AND signal_kind = 'text' AND column_name = '{c}', text_value, NULL)"
    return profile.withColumn("fault", _fault(columns)).groupBy(key).agg(
        F.max("base_len").alias("base_len"),
        F.count_if("used").alias("n_signals"),
        F.min("fault").alias("fault"),
        *[F.expr(f"max({text.format(c=c)}) AS `{c}_text`") for c in columns],
    )


def rejected_flights(
    profile: DataFrame, key: str = KEY, columns: dict[str, str] = SILVER_SIGNALS
) -> DataFrame:
    """Flights that fail as a whole, with the first fault by text order."""
    return (
        profile.withColumn("fault", _fault(columns))
        .groupBy(key)
        .agg(F.min("fault").alias("fault"))
        .filter(F.col("fault").isNotNull())
    )


def text_signals(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("signal_kind") == "text")


def _spread_is_small(profile: DataFrame) -> bool:
    rows = profile.agg(F.sum(F.expr(f"n div {INPUT_BLOCK} + 1")).alias("rows")).first()["rows"]
    return (rows or 0) <= BROADCAST_ROWS


def _shapes(plan: DataFrame, key: str, carry: Sequence[str]) -> tuple[DataFrame, DataFrame] | None:
    """The plan in two tables that are broadcast: (key, base_len, like) per flight and (like, param, factor, repeat,
    carry) per signal of each different shape; None if one has too many rows.

    A shape is what a flight's signals have in common with those of many others: which there are and how each
    is resampled. It goes by the smallest key that has it.
    """
    names = ["param", "factor", "repeat", *carry]
    shape = F.sort_array(F.collect_list(F.struct(*names))).alias("shape")
    whole = plan.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max("base_len").alias("base_len"), shape)
    whole = settle(whole, "flight-shapes")
    if not fits_broadcast(whole, BROADCAST_ROWS):
        return None
    different = settle(whole.groupBy("shape").agg(F.min(key).alias("like")), "shapes")
    if (different.agg(F.sum(F.size("shape"))).first()[0] or 0) > BROADCAST_ROWS:
        return None
    flights = settle(whole.join(F.broadcast(different), "shape").select(key, "base_len", "like"), "flights")
    return flights, different.select("like", F.inline("shape"))


def _pieces(
    signals: DataFrame, plan: DataFrame, small: bool, key: str, carry: Sequence[str] = ()
) -> DataFrame:
    """The output rows of every sample: (key, param, carry, slice, first_row, last_row, value), a row per
    slice of the output that a sample touches; nothing is repeated here.

    ``plan`` holds the profile rows to resample. A small one is broadcast. Of a larger one the flights and the
    different shapes that they have are, so the samples are placed where they are read. If these are too many
    as well, the plan is hashed on a block of the index, so that one long signal is not one join
    key and the samples are shuffled once and never sorted. Samples that share a row are
    averaged first, and mostly in the task that read them: a fast signal goes on as one row per output row.
    """
    samples = signals.filter(F.col("idx").isNotNull()).select(
        key, "param", "idx", F.col("num_value").alias("value")
    )
    shaped = None if small else _shapes(plan, key, carry)
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(n - 1, 0) div {INPUT_BLOCK}"))
    spread = plan.select(
        key, "param", "base_len", "factor", "repeat", *carry, F.explode(blocks).alias("block")
    )

    def placed(factor: str) -> DataFrame:
        if shaped is not None:
            flights, shapes = shaped
            met = samples.join(F.broadcast(flights), key).join(F.broadcast(shapes.filter(factor)), ["like", "param"])
        else:
            part = spread.filter(factor).hint("broadcast" if small else "shuffle_hash")
            blocked = samples.withColumn("block", F.expr(f"idx div {INPUT_BLOCK}"))
            met = blocked.join(part, [key, "param", "block"])
        # a cut-off run at the end and samples past the base length make no row
        return met.withColumn("first_row", F.expr("(idx div factor) * repeat")).filter("first_row < base_len")

    names = [key, "param", *carry]
    faster = (
        placed("factor > 1")
        .groupBy(*names, "first_row")
        .agg(F.avg("value").alias("value"))
        .select(*names, F.expr(f"first_row div {OUTPUT_SLICE}").alias("slice"), "first_row",
                F.col("first_row").alias("last_row"), "value")
    )
    end = F.least(F.col("first_row") + F.col("repeat"), F.col("base_len")) - 1
    slices = F.sequence(F.expr(f"first_row div {OUTPUT_SLICE}"), F.expr(f"end_row div {OUTPUT_SLICE}"))
    others = (
        placed("factor = 1")
        .withColumn("end_row", end)
        .select("*", F.explode(slices).alias("slice"))
        .select(*names, "slice",
                F.greatest(F.col("first_row"), F.col("slice") * OUTPUT_SLICE).alias("first_row"),
                F.least(F.col("end_row"), (F.col("slice") + 1) * OUTPUT_SLICE - 1).alias("last_row"), "value")
    )
    return faster.unionByName(others)


def _rows_of(pieces: DataFrame, *columns: str) -> DataFrame:
    """One row per output row of each piece; at most a slice at a time."""
    return pieces.select(*columns, F.explode(F.sequence("first_row", "last_row")).alias("row_idx"), "value")


def resample(
    signals: DataFrame,
    profile: DataFrame,
    kinds: Iterable[str] = ("down", "up", "pass"),
    key: str = KEY,
) -> DataFrame:
    """Resampled numeric signals in long form: (flight, param, row_idx, value)."""
    plan = profile.filter(F.col("signal_kind").isin(list(kinds)) & F.col("base_len").isNotNull())
    return _rows_of(_pieces(signals, plan, _spread_is_small(profile), key), key, "param")


def other_signals(
    signals: DataFrame,
    profile: DataFrame,
    frames: DataFrame | None = None,
    key: str = KEY,
    columns: dict[str, str] = SILVER_SIGNALS,
) -> DataFrame:
    """The signals of accepted flights that are no column of the aligned rows, in long form:
    (flight, idx, name, num_value, str_value), placed on the same rows as the columns are.

    Whatever a recording contains comes along; no list of names is needed and none is gathered. A text
    signal contributes its value to every row.
    """
    frames = flight_frames(profile, key, columns) if frames is None else frames
    accepted = frames.filter(F.col("fault").isNull()).select(key)
    unknown = profile.filter(F.col("used") & ~F.col("column_name").isin(list(columns)))
    unknown = unknown.join(accepted, key, "left_semi")
    text = F.col("signal_kind") == "text"
    pieces = _pieces(signals, unknown.filter(~text), _spread_is_small(profile), key, carry=["column_name"])
    numbers = _rows_of(pieces, key, "column_name").select(
        key, F.col("row_idx").alias("idx"), F.col("column_name").alias("name"), F.col("value").alias("num_value"),
        F.lit(None).cast("string").alias("str_value"),
    )
    slices = F.sequence(F.lit(0).cast("long"), F.expr(f"(base_len - 1) div {OUTPUT_SLICE}"))
    spread = unknown.filter(text).select(key, "column_name", "text_value", "base_len", F.explode(slices).alias("slice"))
    first = F.col("slice") * OUTPUT_SLICE
    last = F.least(first + OUTPUT_SLICE, F.col("base_len")) - 1
    texts = spread.select(
        key, F.explode(F.sequence(first, last)).alias("idx"), F.col("column_name").alias("name"),
        F.lit(None).cast("double").alias("num_value"), F.col("text_value").alias("str_value"),
    )
    return numbers.unionByName(texts)


def assemble(
    signals: DataFrame,
    profile: DataFrame,
    departures: DataFrame,
    key: str = KEY,
    frames: DataFrame | None = None,
    columns: dict[str, str] = SILVER_SIGNALS,
) -> DataFrame:
    """Silver rows of every accepted flight, plus the row number ``idx``.

    ``columns`` may name further signals with their types; they follow the Silver columns and
    are dropped again when the rows are loaded by name. All others are in ``other_signals``.

    ``profile`` (and ``frames``, if given) should be settled, as they are read more than once.
    ``departures`` has one row per flight with the key and ``flight_departure_dttm`` (and
    ``flight_id`` if that is not the key).

    Pieces of samples are shuffled, not rows: samples that share a row are averaged before, and a
    sample that fills many rows is repeated after. Then a row has one value of each signal.
    """
    frames = flight_frames(profile, key, columns) if frames is None else frames
    accepted = frames.filter(F.col("fault").isNull())
    slots = {c: i for i, c in enumerate(columns)}
    slot = lookup(slots, F.col("column_name"))
    filled = F.col("used") & (F.col("signal_kind") != "text")
    # the samples of the base signal are the rows, so it comes along even without a value
    is_base = F.col("param") == BASE_SIGNAL
    plan = (
        profile.withColumn("slot", F.when(filled, slot))
        .filter(F.col("slot").isNotNull() | is_base)
        .join(accepted.select(key), key, "left_semi")
    )
    known = [*SIGNAL_COLUMNS, *columns]
    pieces = _pieces(
        signals.filter(F.col("param").isin(known)),
        plan,
        _spread_is_small(profile),
        key,
        carry=["slot"],
    ).select(key, "slice", "first_row", "last_row", "slot", "value")
    wide = (
        _rows_of(pieces.repartition(key, "slice"), key, "slice", "slot")
        .groupBy(key, "slice", "row_idx")
        .agg(
            *[
                F.expr(f"max(if(slot = {i}, value, NULL)) AS `{c}_num`")
                for c, i in slots.items()
            ]
        )
    )
    slices = F.sequence(F.lit(0).cast("long"), F.expr(f"(base_len - 1) div {OUTPUT_SLICE}"))
    spread = accepted.join(departures, key, "left").withColumn("slice", F.explode(slices))
    # the rows are already placed by (flight, slice): only the few frame rows move
    rows = wide.join(spread.hint("shuffle_hash"), [key, "slice"])

    def value_of(column: str) -> str:
        number, text = f"`{column}_num`", f"`{column}_text`"
        if columns.get(column) == "string":
            return f"coalesce({text}, CAST({number} AS string))"
        return f"coalesce({number}, CAST({text} AS double))" if column in columns else column

    types = {f.name: f.dataType.simpleString() for f in SILVER.fields} | columns
    return rows.selectExpr(
        "row_idx AS idx",
        *[f"CAST({value_of(c)} AS {kind}) AS `{c}`" for c, kind in types.items()],
    )


def flight_counts(frames: DataFrame, key: str = KEY) -> DataFrame:
    """Rows and columns of each accepted flight; id and departure count as columns."""
    return frames.filter(F.col("fault").isNull()).select(
        key,
        F.col("base_len").alias("n_rows"),
        (F.col("n_signals") + 2).alias("n_columns"),
    )
