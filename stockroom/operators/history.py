"""Daily sales history analytics.

Input: one row per (day, code) with ``units`` (``category``, ``item`` descriptive).
Scale: the history is the big table (days x products); every operator first reduces it
with a partial (map-side) aggregate to (code or category) x month or to one row per day,
and only those reduced tables are joined or windowed. Per-day and per-month tables are
bounded by the calendar (a few thousand rows), so their joins are small by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config
from ..functions.months import fourth_thursday_of_november, month_abbr
from ..functions.numeric import round_even
from ..session import write_table

MONTH_COLS = [m.lower() for m in config.MONTH_ABBR]


def src_history(h: DataFrame) -> DataFrame:
    """Derive year, month number and month period; units coerced (bad -> 0)."""
    return (h.withColumn("units", F.coalesce(F.col("units").cast("double"), F.lit(0.0)))
             .withColumn("y", F.year("day")).withColumn("m", F.month("day"))
             .withColumn("ym", F.trunc("day", "month")))


def full_months(h: DataFrame, min_days: int = config.MIN_DAYS_IN_MONTH) -> DataFrame:
    """Month periods with at least ``min_days`` distinct dates of data."""
    return (h.groupBy("ym").agg(F.countDistinct("day").alias("n_days"))
             .filter(F.col("n_days") >= min_days))


ROWS_PER_TASK = 500_000


def tasks_for(rows: int) -> int:
    """The tasks that ``rows`` rows are dealt to: about ``ROWS_PER_TASK`` each."""
    return max(1, -(-rows // ROWS_PER_TASK))


def by_key(df: DataFrame, key: str | list[str], rows: int) -> DataFrame:
    """``df`` dealt out by ``key``, about ``ROWS_PER_TASK`` of its ``rows`` to a task: the number of tasks follows the rows,
    so what a task holds does not grow with the table. Two frames dealt for the same ``rows`` meet in a join as they lie."""
    return df.repartition(tasks_for(rows), *([key] if isinstance(key, str) else key))


def monthly_cube(h: DataFrame) -> DataFrame:
    """The history reduced once to (code, category, full month): units and the earliest
    day. Every seasonality operator reads this reduction - days x products shrink
    to months x products - instead of the daily rows; it is written once to the shared
    checkpoint folder, so all of them share two scans of the history (one for the month
    calendar, one for the totals). All that is aggregated are numbers, so no rows are sorted. The rows are dealt out
    before they are summed: a share of a file holds about as many totals as rows, and grows with the file."""
    cube = getattr(h, "_monthly_cube", None)
    if cube is None:
        fm = full_months(h).select("ym")  # bounded by the calendar
        rows = h.select("code", "category", "ym", "units", "day").join(F.broadcast(fm), "ym", "left_semi")
        cube = (by_key(rows, ["code", "ym"], h.count()).groupBy("code", "category", "ym")
                 .agg(F.sum("units").alias("units"), F.min("day").alias("first_day"))
                 .withColumn("m", F.month("ym")))
        cube = write_table(cube, "history-cube")
        h._monthly_cube = cube
    return cube


def _monthly(h: DataFrame, key: str) -> DataFrame:
    """(key, ym) unit totals over full months, with the calendar month."""
    return (monthly_cube(h).groupBy(key, "ym").agg(F.sum("units").alias("units"))
            .withColumn("m", F.month("ym")))


def _index(mt: DataFrame, key: str) -> DataFrame:
    """Per key: base = mean monthly units, idx[m] = mean units of calendar month m / base, and ``tot`` = all units. One aggregate with
    a sum and a count for each calendar month; a key's months are then rows again."""
    at = lambda m: F.when(F.col("m") == m, F.col("units"))
    wide = mt.groupBy(key).agg(*[f(at(m)).alias(f"{n}{m}") for m in range(1, 13) for n, f in (("_s", F.sum), ("_n", F.count))])
    months = F.filter(F.array(*[F.struct(F.lit(m).alias("m"), F.col(f"_s{m}").alias("s"), F.col(f"_n{m}").alias("n")) for m in range(1, 13)]),
                      lambda x: x["n"] > 0)
    tot, n = (sum((F.coalesce(F.col(f"{c}{m}"), F.lit(0)) for m in range(1, 13)), F.lit(0)) for c in ("_s", "_n"))
    each = wide.select(key, months.alias("_months"), tot.alias("tot"), F.when(n > 0, tot / n).alias("base")).filter(F.col("base") > 0)
    return (each.select(key, "base", "tot", F.size("_months").alias("n_months"), F.explode("_months").alias("_x"))
                .select(key, F.col("_x.m").alias("m"), "base", "n_months", (F.col("_x.s") / F.col("_x.n")).alias("m_units"), "tot")
                .withColumn("idx", F.col("m_units") / F.col("base")))


def _wide(idx: DataFrame, keys: list[str]) -> DataFrame:
    """Pivot idx (rounded to 2 dp) to jan..dec; the month list is fixed, so no extra pass."""
    p = (idx.withColumn("m_name", F.lower(month_abbr("m")))
            .groupBy(*keys).pivot("m_name", MONTH_COLS).agg(F.first(round_even(F.col("idx"), 2))))
    return p


def category_seasonality(h: DataFrame) -> DataFrame:
    """Per category monthly demand index, average monthly units, peak months list."""
    idx = _index(_monthly(h, "category"), "category")
    wide = _wide(idx, ["category"])
    peaks = idx.groupBy("category").agg(
        F.first("base").alias("base"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("idx") >= config.PEAK_THRESHOLD, F.col("m")))),
                                 lambda m: month_abbr(m)), ", ").alias("peak_months"))
    return (peaks.join(wide, "category")
                 .select("category", round_even(F.col("base"), 0).cast("bigint").alias("avg_units_mo"),
                         *MONTH_COLS, "peak_months"))


def _item_index(h: DataFrame) -> DataFrame:
    """The index rows of items with >= 200 units over full months and >= 6 distinct calendar months."""
    cube = monthly_cube(h)
    mt = (by_key(cube.select("code", "ym", "units").filter(F.col("code").isNotNull()), "code", cube.count())
          .groupBy("code", "ym").agg(F.sum("units").alias("units")).withColumn("m", F.month("ym")))
    return _index(mt, "code").filter((F.col("tot") >= config.MIN_ITEM_UNITS) & (F.col("n_months") >= config.MIN_ITEM_MONTHS))


def _named(h: DataFrame, items: DataFrame) -> DataFrame:
    """``items`` (one row per code) with item and category as on the code's earliest day of a full month (the smallest, if
    that day has several). Only that day's rows of these items are read for them."""
    days = monthly_cube(h).groupBy("code").agg(F.min("first_day").alias("day"))
    first = (h.join(items.select("code").join(days, "code"), ["code", "day"]).groupBy("code")
              .agg(F.min(F.struct("item", "category")).alias("f")))
    return items.join(first, "code").withColumns({"item": F.col("f.item"), "category": F.col("f.category")}).drop("f")


def item_seasonality(h: DataFrame) -> DataFrame:
    """A10: seasonal items - peak month (earliest on ties), peak index >= 1.15, buy-ahead =
    the month before the peak. ``annual_units`` is the total over all full months."""
    peak = _item_index(h).groupBy("code").agg(
        F.first("tot").alias("tot"), F.max("idx").alias("peak_v"),
        F.min_by("m", F.struct(-F.col("idx"), F.col("m"))).alias("peak_m"))
    peak = peak.filter(F.col("peak_v") >= config.PEAK_THRESHOLD)
    return (_named(h, write_table(peak, "item-peaks")).select(
        "code", "item", "category", F.col("tot").cast("bigint").alias("annual_units"),
        month_abbr("peak_m").alias("peak_month"), round_even(F.col("peak_v"), 2).alias("peak_index"),
        month_abbr(F.pmod(F.col("peak_m") - 2, F.lit(12)) + 1).alias("buy_ahead_month")))


def item_month_index(h: DataFrame) -> DataFrame:
    """Per item full 12-month index for the item population of A10."""
    wide = write_table(_wide(_item_index(h), ["code", "base"]), "item-months")
    return (_named(h, wide)
                .select("code", "item", "category", round_even(F.col("base"), 0).cast("bigint").alias("avg_units_mo"),
                        *MONTH_COLS))


def event_days(daily: DataFrame) -> DataFrame:
    """the events of every year present: 4/20, July 4, NYE, Green Wednesday (the day
    before the 4th Thursday of November)."""
    years = daily.select(F.year("day").alias("y")).distinct()
    ev = F.array(
        F.struct(F.concat(F.lit("4/20 "), F.col("y").cast("string")).alias("event"), F.make_date("y", F.lit(4), F.lit(20)).alias("date")),
        F.struct(F.concat(F.lit("July 4 "), F.col("y").cast("string")).alias("event"),
                 F.make_date("y", F.lit(7), F.lit(4)).alias("date")),
        F.struct(F.concat(F.lit("NYE "), F.col("y").cast("string")).alias("event"),
                 F.make_date("y", F.lit(12), F.lit(31)).alias("date")),
        F.struct(F.concat(F.lit("Green Wed "), F.col("y").cast("string")).alias("event"),
                 F.date_sub(fourth_thursday_of_november(F.col("y")), 1).alias("date")))
    return years.select(F.inline(ev))


def event_lift(h: DataFrame, window_days: int = config.EVENT_WINDOW_DAYS) -> DataFrame:
    """A12 + J16: event-day units / median units of the days within +-21 days (event day
    excluded). Days absent from the data are absent from the window; skipped when the event
    day is missing or the baseline is 0. The range join is an equi-join on exploded window
    days, so it is a hash join rather than a nested loop."""
    daily = h.groupBy("day").agg(F.sum("units").alias("units"))
    ev = event_days(daily)
    win = ev.select("event", "date", F.explode(F.sequence(F.date_sub("date", window_days),
                                                          F.date_add("date", window_days))).alias("day")) \
        .filter(F.col("day") != F.col("date"))
    base = win.join(daily, "day").groupBy("event", "date").agg(F.median("units").alias("base"))
    on_day = ev.join(daily.withColumnRenamed("day", "date"), "date")
    out = on_day.join(base, ["event", "date"]).filter(F.col("base") != 0)
    return out.select("event", "date", F.col("units").cast("bigint").alias("units_that_day"),
                      F.col("base").cast("bigint").alias("normal_day"),
                      round_even(F.col("units") / F.col("base"), 1).alias("lift_x"))


def yoy_growth(h: DataFrame) -> DataFrame:
    """A13 + U02: per category the two latest years, months present in both, % change."""
    mt = _monthly(h, "category").withColumn("y", F.year("ym"))
    yrs = mt.select("category", "y").distinct().withColumn(
        "yr_rank", F.dense_rank().over(Window.partitionBy("category").orderBy(F.col("y").desc())))
    two = yrs.filter(F.col("yr_rank") <= 2)
    has_two = two.groupBy("category").agg(F.max("yr_rank").alias("n"), F.min("y").alias("prev_year"),
                                          F.max("y").alias("cur_year")).filter(F.col("n") == 2)
    j = mt.join(has_two, "category")
    prev = j.filter(F.col("y") == F.col("prev_year")).select("category", "m", F.col("units").alias("p"))
    cur = j.filter(F.col("y") == F.col("cur_year")).select("category", "m", F.col("units").alias("c"))
    shared = prev.join(cur, ["category", "m"])  # U02: months present in both years
    s = shared.groupBy("category").agg(F.sum("p").alias("p"), F.sum("c").alias("c")).filter(F.col("p") > 0)
    return (s.join(has_two, "category").select(
        "category", "prev_year", "cur_year", F.col("p").cast("bigint").alias("prev_units"),
        F.col("c").cast("bigint").alias("cur_units"),
        round_even((F.col("c") - F.col("p")) / F.col("p") * 100, 1).alias("yoy_pct")))


def true_velocity(h: DataFrame) -> DataFrame:
    """Trailing 30/90-day units per day against the last date in the data (strict >),
    momentum = 30-day pace / 90-day pace, latest description."""
    last = h.agg(F.max("day")).first()[0]  # one scalar: the data's last date
    j = h.withColumn("_last", F.lit(last))
    g = j.groupBy("code").agg(
        F.sum(F.when(F.col("day") > F.date_sub("_last", 30), F.col("units")).otherwise(0.0)).alias("d30"),
        F.sum(F.when(F.col("day") > F.date_sub("_last", 90), F.col("units")).otherwise(0.0)).alias("d90"),
        F.max_by("item", "day").alias("item"), F.max_by("category", "day").alias("category"))
    return g.select("code", "item", "category",
                    round_even(F.col("d30") / 30, 2).alias("units_day_30"),
                    round_even(F.col("d90") / 90, 2).alias("units_day_90"),
                    F.when(F.col("d90") > 0, round_even((F.col("d30") / 30) / (F.col("d90") / 90), 2)).alias("momentum"))


def category_month_index(h: DataFrame) -> DataFrame:
    """A09's index as rows: (category, m, idx)."""
    return _index(_monthly(h, "category"), "category").select("category", "m", "idx")


def item_month_rows(h: DataFrame) -> DataFrame:
    """A11's index as rows: (code, m, idx) for the item population of A10."""
    return _item_index(h).select("code", "m", "idx")


def next_month_ratio(index: DataFrame, key: str, month: int, clamp: tuple[float, float],
                     require_next: bool = True) -> DataFrame:
    """index(next month) / index(this month) clamped, from the index rows (key, m, idx) rounded to 2 places; only the
    two months are read, in one aggregate. Dec wraps to Jan. Keys with this month's index <= 0 or missing are dropped."""
    after = month % 12 + 1
    at = lambda m: F.max(F.when(F.col("m") == m, round_even(F.col("idx"), 2)))
    two = index.filter(F.col("m").isin(month, after)).groupBy(key).agg(at(month).alias("cur"), at(after).alias("nxt"))
    out = two.filter(F.col("cur") > 0)
    if require_next:
        out = out.filter(F.col("nxt").isNotNull())
    return out.select(F.col(key), F.least(F.greatest(F.col("nxt") / F.col("cur"), F.lit(clamp[0])), F.lit(clamp[1])).alias("factor"))
