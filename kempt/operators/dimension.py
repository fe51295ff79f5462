"""Dimension clean-up: placeholder member, survivor map, FK remap, composite split.

The reference cleans a dimension in several in-place passes (delete lone and
leading-delimiter members, strip trailing delimiters, merge the duplicates that
stripping creates, fold "composite" members into the member named by the text
before the delimiter), moving child foreign keys each time.  Here the whole
clean-up is *one* mapping ``member id -> surviving id``, computed once from
the dimension, materialised in the shared checkpoint folder, and then used for
the preview, the child remap and the cleaned dimension alike.

Scale notes
-----------
* The survivor map is a ``groupBy`` of the dimension (partial aggregation, so a
  name shared by a third of the members still collapses map-side) joined back
  to the members; AQE's skew-join split covers a hot name on the member side.
* Children are remapped with a left join against only the *moved* ids.  That
  map is broadcast when its checked row count is under ``broadcast_max_rows``
  (then the child, typically the big fact table, is never shuffled and a hot
  placeholder key cannot skew anything); above the bound the join is a
  shuffle join with AQE skew splitting.
* Nothing is collected to the driver except the one row count of the map.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.functions.text import strip_chars, text_before
from kempt.operators.broadcast import DEFAULT_MAX_ROWS, bounded_by_rows, size_checked_broadcast
from kempt.session import cut_lineage

CLEAN = "clean"
STRIP = "strip"            # trailing delimiter, recoverable by stripping
COMPOSITE = "composite"    # "<member>,<other text>": belongs to <member>
UNRECOVERABLE = "unrecoverable"  # lone or leading delimiter

_CLS, _KEY, _KEEP, _TARGET = "_cls", "_key", "_keep", "_target"

DEFAULT_BROADCAST_MAX_ROWS = DEFAULT_MAX_ROWS


def member_class(name: Column, delim: str = ",") -> Column:
    """Class of a dimension member name, see module constants."""
    stripped = _stripped(name, delim)
    return (F.when(name.startswith(delim), F.lit(UNRECOVERABLE))
            .when(stripped.contains(delim), F.lit(COMPOSITE))
            .when(name.endswith(delim), F.lit(STRIP))
            .otherwise(F.lit(CLEAN)))


def _stripped(name: Column, delim: str) -> Column:
    return F.when(name.endswith(delim) & ~name.startswith(delim), strip_chars(name, delim)).otherwise(name)


def member_key(name: Column, delim: str = ",") -> Column:
    """The clean name a member stands for: stripped name, or the text before the
    delimiter for composites; NULL when unrecoverable."""
    stripped = _stripped(name, delim)
    cls = member_class(name, delim)
    return (F.when(cls == UNRECOVERABLE, F.lit(None).cast("string"))
            .when(cls == COMPOSITE, text_before(stripped, delim))
            .otherwise(stripped))


def classify_members(dim: DataFrame, name_col: str, delim: str = ",") -> DataFrame:
    """All dimension columns plus ``_cls``, ``_key`` and the stripped name ``_st``.

    Same result as ``member_class`` / ``member_key``, but the stripped name is
    computed once per member and the class once, then reused.
    """
    name = F.col(name_col)
    staged = dim.select("*", _stripped(name, delim).alias("_st"))
    st = F.col("_st")
    cls = (F.when(name.startswith(delim), F.lit(UNRECOVERABLE))
           .when(st.contains(delim), F.lit(COMPOSITE))
           .when(name.endswith(delim), F.lit(STRIP))
           .otherwise(F.lit(CLEAN)))
    staged = staged.select("*", cls.alias(_CLS))
    key = (F.when(F.col(_CLS) == UNRECOVERABLE, F.lit(None).cast("string"))
           .when(F.col(_CLS) == COMPOSITE, text_before(st, delim))
           .otherwise(st))
    return staged.select(*dim.columns, _CLS, key.alias(_KEY), "_st")


@dataclass
class DimensionMerge:
    """Result of planning a dimension clean-up (see ``plan_dimension_merge``)."""

    mapping: DataFrame          # every member: dimension columns + _cls, _key, _st, _target
    id_col: str
    name_col: str
    columns: tuple[str, ...]
    placeholder: dict
    broadcast_max_rows: int
    source: DataFrame | None = None   # the input dimension, for a cheap size bound
    _member_rows: int | None = None

    def member_rows(self) -> int:
        """Rows of the input dimension: an upper bound for every map derived from it.

        Counting the input needs no shuffle (Spark drops the projections and
        counts the scan), so it is the cheap first step of every size check.
        """
        if self._member_rows is None:
            self._member_rows = (self.source if self.source is not None else self.mapping).count()
        return self._member_rows

    def bounded_broadcast(self, derived: DataFrame) -> DataFrame:
        """Broadcast a map derived from the members when its size is proven small:
        by the member count when the map is fixed-width (no extra work), else by
        measuring its rows and bytes exactly."""
        return bounded_by_rows(derived, self.member_rows(), self.broadcast_max_rows)

    # -- the mapping --------------------------------------------------------
    def moved(self) -> DataFrame:
        """``(source_id, target_id)`` for members that disappear."""
        return (self.mapping.where(F.col(_TARGET) != F.col(self.id_col))
                .select(F.col(self.id_col).alias("source_id"), F.col(_TARGET).alias("target_id")))

    def survivor_map(self) -> DataFrame:
        """``(id, member_class, key, target_id)`` for every member."""
        return self.mapping.select(self.id_col, F.col(_CLS).alias("member_class"),
                                   F.col(_KEY).alias("member_key"), F.col(_TARGET).alias("target_id"))

    def unmatched_composites(self) -> DataFrame:
        """Composite members whose prefix names no clean member: kept (one per
        distinct name, identical ones merged into the smallest id) and reported,
        never silently deleted."""
        return (self.mapping.where((F.col(_CLS) == COMPOSITE) & (F.col(_TARGET) == F.col(self.id_col)))
                .select(self.id_col, self.name_col, F.col(_KEY).alias("extracted_name")))

    def composite_targets(self) -> DataFrame:
        """Composite members with the single surviving member their prefix names.

        Joining composites to *every* clean member of that name would emit all
        pairs inside a name group; the survivor map already holds exactly one
        target per name, so the preview reads it instead.
        """
        return (self.mapping.where((F.col(_CLS) == COMPOSITE) & (F.col(_TARGET) != F.col(self.id_col)))
                .select(F.col(self.id_col).alias("current_id"), F.col(self.name_col).alias("current_name"),
                        F.col(_KEY).alias("extracted_name"), F.col(_TARGET).alias("target_id")))

    def removed(self) -> DataFrame:
        """Members deleted by the clean-up, with the reason and the new home of their children."""
        return (self.mapping.where(F.col(_TARGET) != F.col(self.id_col))
                .select(self.id_col, self.name_col, F.col(_CLS).alias("member_class"),
                        F.col(_TARGET).alias("target_id")))

    # -- applying it --------------------------------------------------------
    def remap(self, child: DataFrame, fk: str) -> DataFrame:
        """Child rows with ``fk`` moved to the surviving member; unmatched keys keep
        their value (UPDATE ... FROM semantics)."""
        return remap_foreign_key(child, fk, self.bounded_broadcast(self.moved()), "source_id", "target_id")

    def dimension(self) -> DataFrame:
        """The cleaned dimension: survivors with their repaired name, unmatched
        composites as they are, and the placeholder member exactly once."""
        kept = self.mapping.where((F.col(_TARGET) == F.col(self.id_col)) & (F.col(_CLS) != UNRECOVERABLE))
        name = F.col("_st").alias(self.name_col)   # every kept member loses its trailing delimiters
        clean = kept.select(*[name if c == self.name_col else F.col(c) for c in self.columns])
        return add_member_once(clean, self.id_col, self.placeholder)


def plan_dimension_merge(dim: DataFrame, id_col: str, name_col: str, *, placeholder: dict,
                         delim: str = ",", broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                         materialize: bool = True, case_insensitive: bool = False) -> DimensionMerge:
    """Classify members, pick survivors (``min(id)`` per clean name among clean
    and strippable members) and route every member to its target: a composite
    goes to the survivor its prefix names, else to the smallest id among the
    composites with the same name (duplicates are merged whatever their class).

    ``placeholder`` is the full row of the member that receives the children of
    unrecoverable members, e.g. ``{"id": 0, "name": "N/A", "slug": "n-a"}``.
    With ``materialize`` the mapping is checkpointed to the shared folder, so its
    three consumers (preview, child remap, cleaned dimension) do not recompute it.
    ``case_insensitive`` matches names that differ only in letter case (the
    survivor keeps its own spelling).  A name column with a declared collation
    is matched by that collation; names are classified by their bytes, and the
    mapping's name column keeps the collation.
    """
    collation = getattr(dim.schema[name_col].dataType, "collation", "UTF8_BINARY")
    collated = collation != "UTF8_BINARY"
    members = classify_members(dim.withColumn(name_col, F.collate(name_col, "UTF8_BINARY")) if collated else dim, name_col, delim)
    fold = (lambda c: F.collate(c, collation)) if collated else F.lower if case_insensitive else (lambda c: c)
    members = members.select("*", fold(F.col(_KEY)).alias("_match"), fold(F.col("_st")).alias("_full"))
    # classifying is cheap and is done three times over: each minimum then reads the name and the id alone
    # survivors of clean names: min id among clean and strippable members
    survivors = (members.where(F.col(_CLS).isin(CLEAN, STRIP))
                 .groupBy("_match").agg(F.min(id_col).alias(_KEEP)))
    # identical composite names are duplicates too: min id, used when the
    # prefix names no clean member
    composite_dups = (members.where(F.col(_CLS) == COMPOSITE)
                      .groupBy("_full").agg(F.min(id_col).alias("_keep_full")))
    placeholder_id = F.lit(placeholder[id_col]).cast(dim.schema[id_col].dataType)
    target = (F.when(F.col(_CLS) == UNRECOVERABLE, placeholder_id)
              .otherwise(F.coalesce(F.col(_KEEP), F.col("_keep_full"), F.col(id_col))))
    mapping = (members.join(survivors, "_match", "left")
               .join(composite_dups, "_full", "left")
               .select(*dim.columns, _CLS, _KEY, "_st", target.alias(_TARGET)))
    if collated:
        mapping = mapping.withColumns({c: F.collate(c, collation) for c in (name_col, "_st")})
    if materialize:
        mapping = cut_lineage(mapping)
    return DimensionMerge(mapping, id_col, name_col, tuple(dim.columns), placeholder, broadcast_max_rows,
                          source=dim)


def remap_foreign_key(child: DataFrame, fk: str, mapping: DataFrame,
                      source: str = "source_id", target: str = "target_id") -> DataFrame:
    """``UPDATE child SET fk = map.target FROM map WHERE child.fk = map.source``.

    ``mapping`` must be unique per ``source`` (aggregate it first otherwise);
    pass it through ``F.broadcast`` when its size is known to be small.
    """
    m = mapping.select(F.col(source).alias("_src"), F.col(target).alias("_tgt"))
    joined = child.join(m, child[fk] == F.col("_src"), "left")
    new_fk = F.coalesce(F.col("_tgt").cast(child.schema[fk].dataType), child[fk]).alias(fk)
    return joined.select(*[new_fk if c == fk else child[c] for c in child.columns])


def add_member_once(dim: DataFrame, id_col: str, row: dict) -> DataFrame:
    """Insert a literal member unless its id already exists (INSERT ... placeholder).

    The existence test reads only rows with that id (pushed-down equality on the
    primary key) and keeps one of them, so the broadcast is one row even where
    the id repeats.
    """
    spark = dim.sparkSession
    lit_row = spark.createDataFrame([tuple(row.get(c) for c in dim.columns)], dim.schema)
    present = dim.where(F.col(id_col) == F.lit(row[id_col])).select(id_col).limit(1)
    return dim.unionByName(lit_row.join(F.broadcast(present), id_col, "left_anti"))


def reassign_by_parent(child: DataFrame, fk: str, parent: DataFrame, pk: str, predicate: Column,
                       value, *, broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Set ``child.fk = value`` where the referenced parent matches ``predicate``
    (``UPDATE child SET fk = v WHERE fk IN (SELECT pk FROM parent WHERE p)``)."""
    flagged = parent.where(predicate).select(F.col(pk).alias("source_id")).distinct()
    flagged = flagged.withColumn("target_id", F.lit(value))
    flagged, _ = size_checked_broadcast(cut_lineage(flagged), broadcast_max_rows)
    return remap_foreign_key(child, fk, flagged)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """``DELETE ... WHERE p``: rows where p is NULL are kept (unlike ``filter(~p)``)."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_listed(df: DataFrame, keys: Sequence[str], listed: DataFrame) -> DataFrame:
    """``DELETE t FROM t JOIN listed``: anti join on the key (duplicates in
    ``listed`` are harmless, so no shuffle is spent de-duplicating it)."""
    return df.join(listed.select(*keys), list(keys), "left_anti")
