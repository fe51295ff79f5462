"""URL filters: a temporal list join of captures with dated list entries.

A list is a log of dated events (list, pattern, day, action): ``add`` puts a
host or domain on the list, ``remove`` takes it off.  Events become validity
intervals, one per added stretch.  Every capture is joined, as of its fetch
day, with the intervals of its host and of all the host's parent domains of two
labels or more; the most specific active pattern decides.

Intervals of one pattern never overlap, so a capture meets each of its host's
names at most once per list, and a host that holds many captures is split by
the adaptive join or met by a broadcast of checked size.  Events of the same
pattern and day: the removal stands.  Repeated events count once; events
without pattern, day or a known action are ignored.  Captures with a NULL or
unreadable URL or without a day are kept and not blocked; repeated captures
are judged each.  Of entries of equal length the later name, then the later
start is shown.  Without captures there are no rows, without events nothing is
blocked; further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kempt.llm import common

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
BROADCAST_ROWS = 500_000


def host(url: Column) -> Column:
    """Lower-cased host of a URL; NULL where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def domains(name: Column) -> Column:
    """The host itself and its parent domains of at least two labels (a single label stands for itself)."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def validity(events: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to) of every stretch on a list; ``valid_to`` is exclusive, NULL while open."""
    known = (events.where(F.col("pattern").isNotNull() & F.col("day").isNotNull() & F.col("action").isin("add", "remove"))
             .select("list", F.lower("pattern").alias("pattern"), "day", "action"))
    # one state per day, the removal where both are given
    daily = known.groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))
    order = Window.partitionBy("list", "pattern").orderBy("day")
    changes = daily.withColumn("before", F.lag("action").over(order)).where("before is null or before <> action")
    return (changes.withColumn("valid_to", F.lead("day").over(order)).where("action = 'add'")
            .select("list", "pattern", F.col("day").alias("valid_from"), "valid_to"))


def evaluate(captures: DataFrame, events: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
             day_col: str = "day") -> DataFrame:
    """One row per capture: id, host, day, n_active (entries active then), pattern (the most specific), valid_from, blocked."""
    intervals = common.materialise(validity(events), "intervals")
    small = intervals.count() <= BROADCAST_ROWS
    rows = captures.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"),
                           F.col(day_col).alias("day"))
    names = rows.select("row", "id", "host", "day", F.explode_outer(domains(F.col("host"))).alias("pattern"))
    lists = intervals.select(F.col("list").alias("_list"), F.col("pattern").alias("_pattern"), "valid_from", "valid_to")
    # a list's intervals of one name do not overlap: a name meets at most one a list
    at_fetch = ((F.col("pattern") == F.col("_pattern")) & (F.col("valid_from") <= F.col("day"))
                & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    met = names.join(F.broadcast(lists) if small else lists, at_fetch, "left").withColumn("active", F.col("_list").isNotNull())
    best = F.max(F.when(F.col("active"), F.struct(F.length("pattern").alias("length"), "pattern", "valid_from")))
    judged = met.groupBy("row", "id", "host", "day").agg(F.count_if("active").alias("n_active"), best.alias("best"))
    return judged.select(F.col("id").alias(id_col), "host", F.col("day").alias(day_col), "n_active",
                         F.col("best.pattern").alias("pattern"), F.col("best.valid_from").alias("valid_from"),
                         (F.col("n_active") > 0).alias("blocked"))
