"""Raw events to (date, lon, lat) observations, and to distinct (date, cell) or (span, cell) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.functions import grid, spans


def _parsed(df: DataFrame, date: str, latitude: str, longitude: str) -> DataFrame:
    """``df`` with the columns day, x and y, null where an event has no such value.

    ``try_cast`` gives one rule whether or not ANSI mode is on. The one-element
    ``inline`` keeps Catalyst from copying the parsing into every later filter,
    so each event is parsed once.
    """
    def name(column: str) -> str:
        return "`" + column.replace("`", "``") + "`"

    day = F.substring(F.col(name(date)).cast("string"), 1, grid.DAY_LENGTH)
    parsed = F.struct(
        day.alias("day"),
        F.col(name(longitude)).try_cast("double").alias("x"),
        F.col(name(latitude)).try_cast("double").alias("y"),
    )
    return df.select("*", F.inline(F.array(parsed)))


def _usable() -> Column:
    return F.col("day").isNotNull() & grid.on_grid("x") & grid.on_grid("y")


def _snapped(parsed: DataFrame) -> DataFrame:
    return parsed.select(
        F.col("day").alias("date"), grid.snap("x").alias("lon"), grid.snap("y").alias("lat")
    )


def observations(
    df: DataFrame, date: str = "date", latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """One row per event: day, and location on the grid.

    Strict: an event without a day or with a coordinate that is no finite number
    fails the job. Use ``split_rejects`` to set such events aside instead.
    """
    complaint = F.concat(
        F.lit("event without usable date, longitude and latitude: "),
        F.to_json(F.struct("day", "x", "y")),
    )
    checked = F.when(_usable(), F.lit(True)).otherwise(F.raise_error(complaint))
    return _snapped(_parsed(df, date, latitude, longitude).where(checked))


def split_rejects(
    df: DataFrame, date: str = "date", latitude: str = "latitude", longitude: str = "longitude"
) -> tuple[DataFrame, DataFrame]:
    """Permissive form: (observations, rejected events as they were read)."""
    parsed = _parsed(df, date, latitude, longitude)
    return _snapped(parsed.where(_usable())), parsed.where(~_usable()).select(*df.columns)


def store_split(
    df: DataFrame, path: str, date: str = "date", latitude: str = "latitude", longitude: str = "longitude"
) -> tuple[DataFrame, DataFrame]:
    """``split_rejects`` with one scan of the source for both tables.

    Every event is parsed once and written under ``path``, partitioned by whether it can be used; both results
    read their own partition. What stands at the path is replaced.
    """
    parsed = _parsed(df, date, latitude, longitude)
    usable = _usable()
    observed = F.when(usable, F.struct(F.col("day").alias("date"), grid.snap("x").alias("lon"), grid.snap("y").alias("lat")))
    event = F.when(~usable, F.struct(*[F.col(f"`{name}`") for name in df.columns]))
    marked = parsed.select(observed.alias("observed"), event.alias("event"), usable.alias("usable"))
    marked.write.mode("overwrite").partitionBy("usable").parquet(path)
    # without the schema, a table without events of one kind, or without any, could not be read
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    return stored.where("usable").select("observed.*"), stored.where("NOT usable").select("event.*")


def day_cells(obs: DataFrame) -> DataFrame:
    """Distinct (date, cell): a location counts once per day.

    The shuffle key is (date, cell), after a partial de-duplication in every map
    task, so neither a hot day nor a hot location lands in one task. The null
    filter is spelled out so that every reader of this plan has the same plan and
    Spark reuses its one shuffle.
    """
    cells = obs.select("date", grid.pack("lon", "lat").alias("cell"))
    return cells.where("date IS NOT NULL AND cell IS NOT NULL").distinct()


def cell_spans(obs: DataFrame) -> DataFrame:
    """(span, cell, days): the days of one month of a cell as bits of one bigint.

    The same information as ``day_cells``, de-duplicated by OR-ing bits, with up
    to thirty-one days in a row: partial aggregates and shuffles shrink by as
    much where cells are active often. Key columns are made non-null (nulls are
    filtered first), so that no reader adds a null filter and all share one shuffle.
    """
    complete = obs.where("date IS NOT NULL AND lon IS NOT NULL AND lat IS NOT NULL")
    numbered = complete.select("date", "lon", "lat", spans.number("date").alias("number"))
    rows = numbered.select(
        F.coalesce(spans.span("date", "number"), F.lit("")).alias("span"),
        F.coalesce(grid.pack("lon", "lat"), F.lit(0)).alias("cell"),
        spans.day_bit("number").alias("days"),
    )
    return rows.groupBy("span", "cell").agg(F.bit_or("days").alias("days"))


def daily_locations(obs: DataFrame) -> DataFrame:
    """The set of locations of every day, as flat rows (date, lon, lat).

    Flat, because a day's set has no bound that would make it safe as one array.
    """
    return day_cells(obs).select(
        "date", grid.cell_lon("cell").alias("lon"), grid.cell_lat("cell").alias("lat")
    )


def daily_location_counts(obs: DataFrame) -> DataFrame:
    return day_cells(obs).groupBy("date").agg(F.count("*").alias("n_locations"))


def spread(obs: DataFrame, multiplier: int) -> DataFrame:
    """Round-robin over ``default parallelism x multiplier`` partitions.

    For inputs that arrive in too few splits; otherwise leave the scan's own
    partitioning alone and save the shuffle.
    """
    if multiplier < 1:
        raise ValueError(f"partition multiplier must be positive, found {multiplier}")
    return obs.repartition(obs.sparkSession.sparkContext.defaultParallelism * multiplier)
