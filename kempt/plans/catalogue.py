"""The query catalogue: one Spark job per inventory item, over the driver's tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame built from
the library's operators; ``kempt.plans.oracle`` holds the matching DuckDB SQL
under the same names, with the same output column names and types.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kempt.functions import casts, text
from kempt.model import CASE_AND_TRAILING_BLANKS, STAR_SCHEMA, ForeignKey, TableSpec
from kempt.operators import (broadcast, chains, checks, derived_repairs, digests, dimension, incremental_merge, journal, misspellings, one_pass, profile,
                             profile_state, report, rules)
from kempt.plans.views import TABLES, table, view
from kempt.session import cut_lineage, scratch_path
from kempt.sources import bucketed, delimited, marked_csv, snapshot

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------------------
# Fixed values shared with the oracle
# ---------------------------------------------------------------------------

# Placeholder member for unrecoverable dimension rows (part keys start at 0).
PART_PLACEHOLDER = {"id": -1, "nm": "N/A"}

# Extra repair for the test documents: the injected e-acute mojibake.
DOC_EXTRA_REPAIRS = (("Ã©", "é"),)

# Artifacts tracked before/after repair: label, sequence.
TRACKED_ARTIFACTS = (
    ("apostrophe", "â€™"),
    ("nbsp", "Â"),
    ("o_umlaut", "Ã¶"),
    ("e_acute", "Ã©"),
    ("beta", "Î²"),
)

# Keyed corrections (key, order, search, replacement).
SUPPLIER_KEYED_FIXES = (
    (3, 1, "â€™", "’"),
    (6, 1, "pharmaceuticls", "Pharmaceuticals"),
    (11, 1, "â€™", "’"),
    (14, 1, "pharmaceuticls", "Pharmaceuticals"),
    (22, 1, "pharmaceuticls", "Pharmaceuticals"),
    (30, 1, "pharmaceuticls", "Pharmaceuticals"),
)

# Names with a sharp s where beta was meant (key, order, search, replacement).
PART_BETA_FIXES = ((7, 1, *text.SHARP_S_TO_BETA), (8, 1, *text.SHARP_S_TO_BETA))

# Special characters looked for in names, each in its own count.
SPECIAL_CHARACTERS = (("comma", ","), ("parenthesis", "("), ("double_dash", "--"), ("slash", "/"))

# Container format labels by NULL pattern of (size, price); reports are compared by these names.
FORMAT_LABELS = ("Format B — unit-priced", "Format Mixed — both populated",
                 "Format Placeholder — no pricing", "Empty — both NULL")

PATTERN_NEEDLES = ("idget", "olt", "nvil")
PATTERN_LIKE = "%ol%rod%"

EVENT_TYPES = ("view", "click", "purchase", "signup")
ORDER_STATUSES = ("F", "O")

CONFIRM_IDS = (0, 1, 2, 5)

CAPITALISATION_FIX = ("red plate for economy", "red plate for Economy")

STAGED_ORDERS = TableSpec(
    "staged_orders",
    T.StructType([T.StructField("o_orderkey", T.LongType(), False),
                  T.StructField("o_custkey", T.LongType(), True),
                  T.StructField("o_totalprice", T.DecimalType(10, 2), True)]),
    ("o_orderkey",))
STAGED_CASTS = {"o_custkey": "int", "o_totalprice": "decimal"}


def _v(spark, sf, name):
    return view(spark, sf, name)


def _t(spark, sf, name):
    return table(spark, sf, name)


# ---------------------------------------------------------------------------
# reusable pieces
# ---------------------------------------------------------------------------

def supplier_repair_rules() -> list[rules.Rule]:
    """Ordered name repairs: double spaces, edge spaces, missing period, suffix case."""
    return [
        # each repair implies its own condition, so every rule reads its input once
        rules.Rule("collapse_double_space", "nm", text.collapse_spaces),
        rules.Rule("trim_edges", "nm", F.trim),
        rules.Rule("append_period", "nm", lambda c: text.append_if_endswith(c, "Ltd", ".")),
        rules.Rule("suffix_case", "nm", lambda c: text.replace_when_endswith(c, "ltd.", "ltd.", "Ltd.")),
    ]


def repaired_supplier(spark, sf) -> DataFrame:
    """dirty_supplier names after the ordered repairs."""
    return rules.apply_rules(_v(spark, sf, "dirty_supplier").select("id", "nm"), supplier_repair_rules())


def doc_repair_rules() -> list[rules.Rule]:
    """The mojibake chain plus the injected e-acute repair, as replace rules."""
    pairs = tuple(text.MOJIBAKE_REPAIRS) + DOC_EXTRA_REPAIRS
    return [rules.replace_rule(f"replace_{i}", "text", a, b) for i, (a, b) in enumerate(pairs)]


def part_merge(spark, sf, materialize: bool = True) -> dimension.DimensionMerge:
    """The dimension merge of dirty_part (placeholder id -1)."""
    return dimension.plan_dimension_merge(_v(spark, sf, "dirty_part"), "id", "nm",
                                          placeholder=PART_PLACEHOLDER, materialize=materialize)


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def q01_null_profile(spark, sf):
    """NULL profile of every column in one scan (QC1-2, AG2-3, FLT3)."""
    return checks.null_profile(_v(spark, sf, "dirty_customer"),
                               ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


def q02_blank_and_whitespace(spark, sf):
    """Blank, edge-whitespace and extra-space counts per text column (QC3, QC11, FLT14)."""
    sup = checks.text_hygiene(_v(spark, sf, "dirty_supplier"), ["nm"])
    cus = checks.text_hygiene(_v(spark, sf, "dirty_customer"), ["c_name", "c_mktsegment"])
    return (sup.select(F.lit("dirty_supplier").alias("table_name"), "*")
            .unionByName(cus.select(F.lit("dirty_customer").alias("table_name"), "*")))


def q03_duplicate_values(spark, sf):
    """Duplicate values of one column (QC4, AG5)."""
    return checks.duplicate_groups(_t(spark, sf, "part"), ["p_name"])


def q04_duplicate_rows_composite_null_keys(spark, sf):
    """Duplicate rows on a composite key where NULL keys group together (QC5)."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_orderkey") % 5 != 0, F.col("l_linenumber")).alias("l_linenumber"),
        "l_returnflag")
    return checks.duplicate_groups(li, ["l_orderkey", "l_linenumber", "l_returnflag"])


def q05_duplicate_group_count(spark, sf):
    """Number of duplicated texts and their rows, exact, via hash prefilter (QC6, AG13)."""
    groups = checks.duplicate_text_groups(_t(spark, sf, "documents"), "text")
    return checks.duplicate_summary(groups)


def q06_non_ascii_rows(spark, sf):
    """Rows with non-ASCII names and the code point of the first one (QC7, QC9, FLT11)."""
    ds = _v(spark, sf, "dirty_supplier")
    return (ds.where(text.has_non_ascii("nm"))
            .select("id", "nm", text.code_point_at("nm", text.first_non_ascii_pos("nm")).alias("char_code")))


def q07_code_point_discovery_first(spark, sf):
    """Code points at the first artifact, grouped, with example and count (QC8, AG7, AG11)."""
    return profile.first_artifact_examples(_v(spark, sf, "dirty_docs"), "text", "doc_id", width=3)


def q08_code_point_discovery_all(spark, sf):
    """Every non-ASCII run in every text, with occurrences and rows (QC8 variant)."""
    return profile.all_artifact_runs(_v(spark, sf, "dirty_docs"), "text", "doc_id")


def q09_residual_artifacts_after_repair(spark, sf):
    """Rows holding each artifact before and after the repair chain (QC10)."""
    dd = _v(spark, sf, "dirty_docs")
    fixed = rules.fold(doc_repair_rules(), F.col("text"))
    metrics = {}
    for label, seq in TRACKED_ARTIFACTS:
        metrics[f"{label}__before"] = checks.count_where(F.col("text").contains(seq))
        metrics[f"{label}__after"] = checks.count_where(fixed.contains(seq))
    wide = checks.run_checks(dd, metrics)
    entries = [F.struct(F.lit(label).alias("artifact"), F.col(f"{label}__before").alias("rows_before"),
                        F.col(f"{label}__after").alias("rows_after")) for label, _ in TRACKED_ARTIFACTS]
    return wide.select(F.inline(F.array(*entries)))


def q10_delimiter_classes(spark, sf):
    """Counts of lone / leading / trailing / both-parts delimiters and encoding issues (QC13, AG3)."""
    issue = text.delimiter_issue("nm")
    return checks.run_checks(_v(spark, sf, "dirty_part"), {
        "lone_comma": checks.count_where(issue == "lone"),
        "leading_comma": checks.count_where(issue == "leading"),
        "trailing_comma": checks.count_where(issue == "trailing"),
        "both_parts": checks.count_where(issue == "both_parts"),
        "encoding_issues": checks.non_ascii_count("nm"),
    })


def q11_delimiter_rows(spark, sf):
    """Rows with a delimiter defect and their class (QC12, FLT6-8)."""
    return (_v(spark, sf, "dirty_part").where(F.col("nm").contains(","))
            .select("id", "nm", text.delimiter_issue("nm").alias("issue")))


def q12_suffix_variant_counts(spark, sf):
    """Case-sensitive company-suffix variant counts (QC14, FLT15)."""
    nm = F.col("nm")
    return checks.run_checks(_v(spark, sf, "dirty_supplier"), {
        "ltd_with_period": checks.count_where(nm.endswith("Ltd.")),
        "ltd_without_period": checks.count_where(nm.endswith("Ltd")),
        "limited": checks.count_where(nm.endswith("Limited")),
        "lowercase_ltd_period": checks.count_where(nm.endswith("ltd.")),
        "lowercase_ltd_no_period": checks.count_where(nm.endswith(" ltd")),
    })


def q13_suffix_variant_labels(spark, sf):
    """Suffix variant label per matching row, case-insensitive filter (PRJ6, FLT16)."""
    # case-insensitive filter: lower() equals a UTF8_LCASE comparison for these
    # values without the collation library's start-up cost on each executor
    ci = F.lower(F.col("nm"))
    return (_v(spark, sf, "dirty_supplier").where(ci.contains("ltd") | ci.contains("limited"))
            .select("id", "nm", text.suffix_variant("nm").alias("variation")))


def q14_lowercase_words_with_exclusions(spark, sf):
    """Names with a lower-case word outside the allowed connectors (QC15, FLT10, FLT12)."""
    sup = _v(spark, sf, "dirty_supplier").select(F.lit("dirty_supplier").alias("table_name"), "id",
                                                 F.col("nm").alias("name"))
    prt = _t(spark, sf, "part").select(F.lit("part").alias("table_name"), F.col("p_partkey").alias("id"),
                                       F.col("p_name").alias("name"))
    return sup.unionByName(prt).where(text.has_lowercase_word("name"))


def q15_pattern_any_search(spark, sf):
    """OR of contains patterns plus a multi-wildcard LIKE (FLT20, FLT9)."""
    p = _t(spark, sf, "part")
    return (p.where(text.contains_any("p_name", PATTERN_NEEDLES) | F.col("p_name").like(PATTERN_LIKE))
            .select("p_partkey", "p_name"))


def q16_case_insensitive_group(spark, sf):
    """Names equal up to letter case, with their distinct spellings (FLT16)."""
    # lower() keys keep the aggregate hash-based; grouping on a UTF8_LCASE
    # collated key plans a sort-based aggregate in Spark 4.1
    pv = _v(spark, sf, "part_variants")
    groups = checks.duplicate_groups(pv.select(F.col("nm").alias("name_key"), "nm"), ["name_key"],
                                     case_insensitive=True, extra={"n_spellings": F.count_distinct("nm")})
    return groups.select("name_key", "n_rows", "n_spellings")


def q17_mojibake_repair_chain(spark, sf):
    """Ordered mojibake repair of whole texts; restored = equals the clean original (FX9-13, FX23)."""
    dd = _v(spark, sf, "dirty_docs")
    fixed = rules.apply_rules(dd, doc_repair_rules())
    return fixed.select("doc_id", F.col("text").alias("fixed_text"),
                        (F.col("text") == F.col("expected")).cast("int").alias("restored"))


def q18_keyed_repairs(spark, sf):
    """Targeted corrections by key from an ordered rule table (FX7, FX14)."""
    ds = _v(spark, sf, "dirty_supplier").select("id", "nm")
    fixes = spark.createDataFrame(list(SUPPLIER_KEYED_FIXES), "id long, seq int, search string, replacement string")
    return rules.apply_keyed_replacements(ds, "id", "nm", fixes)


def q19_suffix_space_case_repairs(spark, sf):
    """Ordered name repairs: spaces, edges, missing period, suffix case (FX2, FX4-6)."""
    return repaired_supplier(spark, sf)


def q20_dimension_merge_fk_remap(spark, sf):
    """Flagship: merge a dimension and count fact rows per surviving member (FX15-21, FX25)."""
    merge = part_merge(spark, sf, materialize=False)
    li = merge.remap(_t(spark, sf, "lineitem").select("l_partkey"), "l_partkey")
    return li.groupBy(F.col("l_partkey").alias("target_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def q21_survivor_map(spark, sf):
    """Class, clean key and surviving member of every dimension member (AG10, FX18)."""
    return part_merge(spark, sf, materialize=False).survivor_map()


def q22_composite_split_preview(spark, sf):
    """Composite members, the member their prefix names, and their child rows (FX20, FX24, JN7)."""
    merge = part_merge(spark, sf, materialize=False)
    comp = merge.composite_targets()
    per_part = (_t(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("current_id"))
                .agg(F.count(F.lit(1)).alias("_n")))
    j = comp.join(per_part, "current_id", "left")
    return j.select("current_id", "current_name", "extracted_name", "target_id",
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("child_rows"))


def q23_composite_without_clean_match(spark, sf):
    """Composite members whose prefix names no clean member: kept and reported (FX20 guard)."""
    return part_merge(spark, sf, materialize=False).unmatched_composites()


def q24_delete_by_predicate_and_join(spark, sf):
    """Delete by predicate (NULL-safe) and by a listed key set (FX17, FX19)."""
    merge = part_merge(spark, sf)
    dp = merge.mapping.select("id", "nm")
    step1 = dimension.delete_where(dp, F.col("nm").startswith(","))
    return dimension.delete_listed(step1, ["id"], merge.removed())


def q25_reassign_fk_by_parent_predicate(spark, sf):
    """Move child keys to the placeholder when the parent matches a predicate (FX16, JN8)."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber",
                                          F.col("l_partkey").alias("old_partkey"), "l_partkey")
    moved = dimension.reassign_by_parent(li, "l_partkey", _v(spark, sf, "dirty_part"), "id",
                                         F.col("nm").startswith(","), PART_PLACEHOLDER["id"])
    return moved.where(F.col("l_partkey") != F.col("old_partkey"))


def q26_insert_placeholder_once(spark, sf):
    """Insert the placeholder member once, idempotently (FX15, SNK3)."""
    dp = _v(spark, sf, "dirty_part")
    once = dimension.add_member_once(dp, "id", PART_PLACEHOLDER)
    return dimension.add_member_once(once, "id", PART_PLACEHOLDER)


def q27_change_preview_log(spark, sf):
    """Before/after values a rule list would change (FX24)."""
    ds = _v(spark, sf, "dirty_supplier").select("id", "nm")
    return rules.preview_changes(ds, ["id"], supplier_repair_rules())


def q28_orphans_mandatory(spark, sf):
    """Orphan rows and keys of a mandatory foreign key; NULL counts as orphan (QC20, JN5)."""
    return checks.orphan_count(_v(spark, sf, "dirty_orders"), "o_custkey",
                               _t(spark, sf, "customer"), "c_custkey")


def q29_orphans_optional(spark, sf):
    """Orphans of an optional foreign key; NULL allowed (QC21, JN6)."""
    return checks.orphan_count(_v(spark, sf, "dirty_customer"), "c_nationkey",
                               _t(spark, sf, "nation"), "n_nationkey", optional=True)


def q30_integrity_report(spark, sf):
    """One issue count per foreign key of the star schema (QC34, AG18)."""
    tables = {n: _t(spark, sf, n) for n in STAR_SCHEMA}
    rels = checks.spec_relations(tables, STAR_SCHEMA)
    rels.append(checks.Relation("dirty_orders.o_custkey -> customer.c_custkey",
                                _v(spark, sf, "dirty_orders"), "o_custkey", tables["customer"], "c_custkey"))
    return checks.integrity_report(rels)


def q31_cardinality_over_bound(spark, sf):
    """Parents with more than 3 children and the largest group (QC22)."""
    return checks.groups_over_bound(_t(spark, sf, "lineitem"), ["l_orderkey"], 3)


def q32_cardinality_histogram(spark, sf):
    """How many parents have 1, 2, 3 ... children (QC23, AG14)."""
    return profile.cardinality_histogram(_t(spark, sf, "lineitem"), ["l_orderkey"])


def q33_frequency_table(spark, sf):
    """Value frequencies, most frequent first (QC24, AG4)."""
    docs = profile.frequency(_t(spark, sf, "documents"), F.col("source").alias("value"), ordered=False)
    evts = profile.frequency(_t(spark, sf, "events"), F.col("event_type").alias("value"), ordered=False)
    return (docs.select(F.lit("documents.source").alias("column_name"), "value", "frequency")
            .unionByName(evts.select(F.lit("events.event_type").alias("column_name"), "value", "frequency")))


def q34_format_classification(spark, sf):
    """Rows per NULL-pattern format label (QC25, AG6)."""
    c = _v(spark, sf, "containers")
    label = profile.classify_null_pattern(F.col("container_size"), F.col("unit_price"), FORMAT_LABELS)
    return c.groupBy(label.alias("format_type")).agg(F.count(F.lit(1)).alias("row_count"))


def q35_null_rate_by_dimension(spark, sf):
    """NULL rate of a column per parent member, members with NULLs only (QC26, AG8)."""
    return profile.null_rate_by_member(_v(spark, sf, "dirty_customer"), "c_nationkey",
                                       _t(spark, sf, "nation"), "n_nationkey", "n_name", "c_mktsegment")


def q36_placeholder_usage(spark, sf):
    """Members and child rows routed to the placeholder (QC27)."""
    merge = part_merge(spark, sf)
    ph = PART_PLACEHOLDER["id"]
    members = merge.removed().where(F.col("target_id") == ph).agg(
        F.lit("members_to_placeholder").alias("metric"), F.count(F.lit(1)).alias("value"))
    li = merge.remap(_t(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), "l_partkey")
    usage = li.where(F.col("l_partkey") == ph).agg(F.count(F.lit(1)).alias("rows"),
                                                   F.count_distinct("l_orderkey").alias("orders"))
    usage = usage.select(F.inline(F.array(
        F.struct(F.lit("child_rows_on_placeholder").alias("metric"), F.col("rows").alias("value")),
        F.struct(F.lit("orders_affected").alias("metric"), F.col("orders").alias("value")))))
    return members.unionByName(usage)


def q37_distribution_including_zero(spark, sf):
    """Children per parent member, zero included (QC28, AG15)."""
    nation = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    cus = profile.children_per_member(nation, "n_nationkey", _t(spark, sf, "customer"), "c_nationkey")
    sup = profile.children_per_member(nation, "n_nationkey", _t(spark, sf, "supplier"), "s_nationkey")
    return (cus.select(F.lit("customer").alias("child_table"), "*")
            .unionByName(sup.select(F.lit("supplier").alias("child_table"), "*")))


def q38_distinct_coverage(spark, sf):
    """Distinct coverage of both sides of a link (QC29, AG12)."""
    return profile.distinct_coverage(_t(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


def q39_numeric_range(spark, sf):
    """Min / max / sum / avg of a decimal column (QC18, AG9)."""
    li = _t(spark, sf, "lineitem").select(F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    return (profile.numeric_range(li, "price", with_sum=True)
            .withColumn("avg_value", F.round(F.col("avg_value").cast("double"), 4)))


def q40_max_row_with_context(spark, sf):
    """Rows at the column maximum joined to their parents (QC19, FLT19, JN2)."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    top, _ = broadcast.size_checked_broadcast(cut_lineage(profile.rows_at_max(li, "l_extendedprice")))
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    part = _t(spark, sf, "part").select("p_partkey", "p_name")
    j = top.join(orders, top["l_orderkey"] == orders["o_orderkey"])
    j = j.join(part, j["l_partkey"] == part["p_partkey"])
    return j.select("l_orderkey", "l_linenumber", "l_extendedprice", "o_orderpriority", "p_name")


def q41_domain_values(spark, sf):
    """Values outside an allowed domain, with counts (QC17)."""
    ev = profile.domain_violations(_t(spark, sf, "events"), "event_type", EVENT_TYPES)
    od = profile.domain_violations(_t(spark, sf, "orders"), "o_orderstatus", ORDER_STATUSES)
    return (ev.select(F.lit("events.event_type").alias("column_name"), F.col("event_type").alias("value"),
                      "n_rows")
            .unionByName(od.select(F.lit("orders.o_orderstatus").alias("column_name"),
                                   F.col("o_orderstatus").alias("value"), "n_rows")))


def q42_row_count_report(spark, sf):
    """Row count of every table, unioned and sorted (QC31, SE1, SO4)."""
    return report.row_count_report({n: _t(spark, sf, n) for n in TABLES})


def supplier_summary(df: DataFrame) -> DataFrame:
    """Wide per-table summary of the supplier names, duplicate count included (one pipeline)."""
    return checks.value_summary(df, "nm", {
        "null_names": lambda v: v.isNull(),
        "blank_names": text.is_blank,
        "double_spaces": lambda v: v.contains("  "),
        "edge_whitespace": text.has_edge_whitespace,
        "encoding_issues": text.has_non_ascii,
        "ltd_without_period": lambda v: v.endswith("Ltd"),
        "lowercase_ltd": lambda v: v.endswith("ltd."),
    }, duplicates_col="duplicate_names")


def q43_table_summary_wide(spark, sf):
    """Wide per-table summary incl. duplicate names, one pipeline (QC32, AG16)."""
    return supplier_summary(_v(spark, sf, "dirty_supplier"))


def q44_validation_vs_expected(spark, sf):
    """Checks after repair compared with expectations and documented exceptions (QC33, FX22)."""
    actual = checks.to_long(supplier_summary(repaired_supplier(spark, sf)))
    zero = [(name, 0, None) for name in ("null_names", "blank_names", "double_spaces", "edge_whitespace",
                                         "ltd_without_period", "lowercase_ltd", "duplicate_names")]
    expected = report.expectations(spark, zero)
    raw = _v(spark, sf, "dirty_supplier")
    derived = raw.agg(F.count(F.lit(1)).alias("total_rows"),
                      checks.count_where(text.has_non_ascii("nm")).alias("encoding_issues"))
    derived = derived.select(F.inline(F.array(
        F.struct(F.lit("total_rows").alias("check_name"), F.col("total_rows").alias("expected"),
                 F.lit(None).cast("string").alias("note")),
        F.struct(F.lit("encoding_issues").alias("check_name"), F.col("encoding_issues").alias("expected"),
                 F.lit("intentional non-ASCII characters kept after repair").alias("note")))))
    return report.validate(actual, expected.unionByName(derived))


def q45_encoding_report(spark, sf):
    """Non-ASCII row counts per text column (QC35)."""
    specs = [("documents.text", "documents", "text"), ("pages.html", "pages", "html"),
             ("conversations.text", "conversations", "text"), ("benchmark.text", "benchmark", "text")]
    parts = [_t(spark, sf, t).agg(checks.non_ascii_count(c).alias("issue_count"))
             .select(F.lit(name).alias("check_name"), "issue_count") for name, t, c in specs]
    return reduce(DataFrame.unionByName, parts)


def q46_sample_first_n(spark, sf):
    """First 5 rows by key (QC36, SO3)."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                       "o_orderpriority")
    return report.sample_first(o, ["o_orderkey"], 5)


def q47_before_after_diff(spark, sf):
    """Row-level diff of a dimension before and after cleaning (QC37)."""
    merge = part_merge(spark, sf)
    before = merge.mapping.select("id", "nm")
    return report.diff_snapshots(before, merge.dimension(), ["id"])


def q48_side_effect_check(spark, sf):
    """New duplicates and orphans after the merge (QC30)."""
    merge = part_merge(spark, sf)
    dim = merge.dimension()
    dups = checks.duplicate_summary(checks.duplicate_groups(dim, ["nm"])).select(
        F.lit("new_duplicate_names").alias("check_name"), F.col("duplicate_groups").alias("issue_count"))
    li = merge.remap(_t(spark, sf, "lineitem").select("l_partkey"), "l_partkey")
    orph = checks.orphan_count(li, "l_partkey", dim, "id").select(
        F.lit("orphaned_children").alias("check_name"), F.col("orphan_rows").alias("issue_count"))
    return dups.unionByName(orph)


def _staged_orders(spark, sf, lenient=True):
    raw = _v(spark, sf, "raw_orders_text")
    return delimited.type_staged(raw, STAGED_ORDERS, STAGED_CASTS, lenient=lenient)


def q49_lenient_integer_load(spark, sf):
    """Text ids to BIGINT, exact beyond 2^53; NULL on junk (SRC2, SNK2, SNK4)."""
    return _staged_orders(spark, sf).select("o_orderkey", "o_custkey")


def q50_lenient_decimal_load(spark, sf):
    """Text prices to DECIMAL(10,2); NULL on junk (SRC3)."""
    return _staged_orders(spark, sf).select("o_orderkey", "o_totalprice")


def q51_cast_failure_counts(spark, sf):
    """Non-blank text lost by each lenient cast (X10)."""
    raw = _v(spark, sf, "raw_orders_text")
    return delimited.cast_failures(raw, {
        "o_custkey": casts.lenient_int("o_custkey", "bigint"),
        "o_totalprice": casts.lenient_decimal("o_totalprice", 10, 2),
    })


def q52_csv_round_trip(spark, sf):
    """Ordered CSV export to the shared folder and typed read-back (SRC1, SNK1, SNK5)."""
    spec = STAR_SCHEMA["supplier"]
    src = _t(spark, sf, "supplier").select(*spec.columns)
    src = src.withColumn("s_suppkey", F.col("s_suppkey") + F.lit(9007199254740993))  # keys no double holds
    path = scratch_path(spark, "supplier-csv")
    snapshot.export_csv(src, path, spec.primary_key, integer_columns=("s_suppkey", "s_nationkey"))
    return delimited.read_delimited(spark, path, spec.schema)


def q53_targeted_confirmation(spark, sf):
    """Confirm repaired rows by id and by pattern (QC38)."""
    fixed = repaired_supplier(spark, sf)
    return fixed.where(F.col("id").isin(*CONFIRM_IDS) | F.col("nm").like("%pharmaceuticls%"))


def q54_topn_children_with_parent(spark, sf):
    """Top 20 children joined to their parent, exact (JN10, SO1-3)."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                          "l_extendedprice")
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return profile.top_n_with_parent(li, "l_orderkey", orders, "o_orderkey", order, 20)


def q55_distinct_projection(spark, sf):
    """Distinct projection (PRJ5)."""
    return _t(spark, sf, "part").select("p_brand", "p_type").distinct()


def q56_name_capitalisation_review(spark, sf):
    """Capitalisation fix by value, then review names with connector words (QC16, FX1, FX8)."""
    fn = _v(spark, sf, "form_names")
    old, new = CAPITALISATION_FIX
    fixed = rules.apply_rules(fn, [rules.set_value("capitalise", "nm", new, F.col("nm") == old)])
    return fixed.where(text.has_connector_word("nm"))



def q57_impact_listing(spark, sf):
    """Child rows of every member that moves, with the old and the new member:
    child x moved members x (survivor aggregate) x cleaned dimension again."""
    merge = part_merge(spark, sf)
    targets = merge.dimension().select(F.col("id").alias("target_id"), F.col("nm").alias("target_name"))
    moved = merge.removed().select(F.col("id").alias("current_id"), F.col("nm").alias("current_name"),
                                   "member_class", "target_id")
    moved = merge.bounded_broadcast(cut_lineage(moved.join(targets, "target_id")))  # joined once, then measured
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    j = li.join(moved, li["l_partkey"] == moved["current_id"])
    return j.select("l_orderkey", "l_linenumber", "current_id", "current_name", "member_class", "target_id",
                    "target_name")




def q58_before_after_summary(spark, sf):
    """Rows added / removed / changed / unchanged by the dimension clean-up (QC37 outcome table)."""
    merge = part_merge(spark, sf)
    diff = report.diff_snapshots(merge.mapping.select("id", "nm"), merge.dimension(), ["id"])
    return report.diff_summary(diff)


def q59_published_stage_verification(spark, sf):
    """Publish the merged dimension and remapped facts as a snapshot, then verify what was
    written: no duplicate names beyond the reported composites, no orphans (stage, QC30, SRC5)."""
    from kempt.plans.stage import clean_dimension_stage

    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    res = clean_dimension_stage(spark, dimension_name="part", dim=_v(spark, sf, "dirty_part"), id_col="id",
                                name_col="nm", placeholder=PART_PLACEHOLDER,
                                children={"lineitem": (li, "l_partkey")},
                                out_root=scratch_path(spark, "part-stage"))
    return res.verification


def q60_spec_driven_report(spark, sf):
    """Every declared NOT NULL, primary-key, UNIQUE and foreign-key constraint of the star
    schema as a check row (SRC4, QC1, QC4-5, QC20, QC34)."""
    return checks.spec_report({n: _t(spark, sf, n) for n in STAR_SCHEMA}, STAR_SCHEMA)


def q61_code_point_discovery_by_key(spark, sf):
    """First-artifact discovery with the smallest document id as example: hash aggregate, no
    sort of whole texts (QC8 at scale)."""
    return profile.first_artifact_discovery(_v(spark, sf, "dirty_docs"), "text", width=3, example_key="doc_id")



def q62_orphans_of_clean_relation(spark, sf):
    """A relation without orphans, on both sides of the broadcast bound: 0 rows and 0 keys each (QC20, QC21, QC34)."""
    li, part = _t(spark, sf, "lineitem"), _t(spark, sf, "part")
    broadcasted = checks.orphan_count(li, "l_partkey", part, "p_partkey")
    shuffled = checks.orphan_count(li, "l_partkey", part, "p_partkey", broadcast_max_rows=0)
    return (broadcasted.select(F.lit("broadcast").alias("plan"), "*")
            .unionByName(shuffled.select(F.lit("shuffle").alias("plan"), "*")))


def drifted_suppliers(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Two supplier snapshots: a column was added, one dropped, a row removed, and one key is NULL."""
    sup = _t(spark, sf, "supplier")
    key = F.when(F.col("s_suppkey") != 3, F.col("s_suppkey")).alias("id")
    before = sup.select(key, "s_name", F.when(F.col("s_suppkey") % 5 == 0, F.lit("old")).alias("legacy"))
    after = sup.where(F.col("s_suppkey") != 4).select(key, "s_name", F.when(F.col("s_suppkey") % 7 == 0, F.lit("new")).alias("tag"))
    return before, after


def q63_diff_with_schema_drift(spark, sf):
    """Diff of two snapshots where a column was added, one dropped, and a key is NULL (QC37)."""
    return report.diff_snapshots(*drifted_suppliers(spark, sf), ["id"])


def q64_strict_integer_load(spark, sf):
    """Strict cast of clean id text, exact beyond 2^53; bad text would raise (SRC1, SC11)."""
    raw = _t(spark, sf, "orders").select("o_orderkey", F.concat(
        (F.col("o_custkey") + F.lit(9007199254740993)).cast("string"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(".0")).otherwise(
            F.lit(""))).alias("raw"))
    return raw.select("o_orderkey", casts.strict_int("raw", "bigint").alias("o_custkey"))


def q65_special_characters(spark, sf):
    """Rows holding a comma, parenthesis, double dash or slash (QC12)."""
    nm = F.concat("nm", F.when(F.col("id") % 5 == 0, F.lit(" (Pvt)")).when(F.col("id") % 5 == 1, F.lit(" -- x"))
                  .when(F.col("id") % 5 == 2, F.lit(" a/b")).otherwise(F.lit("")))
    return checks.run_checks(_v(spark, sf, "dirty_part").select(nm.alias("nm")),
                             {label: checks.contains_count("nm", needle) for label, needle in SPECIAL_CHARACTERS})


def q66_full_dimension_pipeline(spark, sf):
    """Strip, merge, split and encode one dimension, then the keyed beta repair (FX14, FX18, FX20, FX21)."""
    part = _v(spark, sf, "dirty_part")
    part = part.select("id", F.when(F.col("id").isin(7, 8), F.concat("nm", F.lit(" ß-blocker")))
                       .when(F.col("id") % 40 == 9, F.concat("nm", F.lit(" Doctorâ€™s"))).otherwise(F.col("nm")).alias("nm"))
    merged = dimension.plan_dimension_merge(part, "id", "nm", placeholder=PART_PLACEHOLDER).dimension()
    encoded = rules.apply_rules(merged, [rules.Rule("encode", "nm", text.repair_mojibake)])
    fixes = spark.createDataFrame(list(PART_BETA_FIXES), "id long, seq int, search string, replacement string")
    return rules.apply_keyed_replacements(encoded, "id", "nm", fixes)


def q67_case_insensitive_collation(spark, sf):
    """Names equal under the case-insensitive collation, with their distinct spellings (FLT16)."""
    pv = _v(spark, sf, "part_variants")
    groups = checks.duplicate_groups(pv.select(F.col("nm").alias("name_key"), "nm"), ["name_key"], collation="UTF8_LCASE",
                                     extra={"n_spellings": F.count_distinct("nm")})
    return groups.select(F.lower(F.collate("name_key", "UTF8_BINARY")).alias("name_key"), "n_rows", "n_spellings")


def chained_moves(spark, sf) -> DataFrame:
    """A map of part keys that holds chains of up to 70 steps, rings of five, ways into them, and members that stay."""
    part = _t(spark, sf, "part").select(F.col("p_partkey").alias("source_id"))
    place = F.col("source_id") % 100
    step = (F.when(place.between(1, 70), F.col("source_id") - 1).when(place.between(80, 83), F.col("source_id") + 1)
            .when(place == 84, F.col("source_id") - 4).when(place.between(85, 89), F.col("source_id") - 1)
            .when(place == 95, F.col("source_id")))
    return part.select("source_id", step.alias("target_id")).where("target_id is not null")


def stage_maps(spark, sf) -> list[DataFrame]:
    """Three stages that move part keys, each of its own kind (strip, merge, split)."""
    part = _t(spark, sf, "part").select(F.col("p_partkey").alias("id"))
    return [part.where(F.col("id") % 4 == 3).select(F.col("id").alias("source_id"), (F.col("id") - 1).alias("target_id")),
            part.where(F.col("id") % 8 == 2).select(F.col("id").alias("source_id"), (F.col("id") - 2).alias("target_id")),
            part.where(F.col("id") % 16 == 8).select(F.col("id").alias("source_id"), (F.col("id") + 3).alias("target_id"))]


def q68_chained_remap(spark, sf):
    """Every source of a map whose targets move too: the end of its chain, or the cycle it leads into (FX25)."""
    return chains.resolve_chains(chained_moves(spark, sf)).report()


def q69_children_of_chained_remap(spark, sf):
    """Line items per part after moving straight to the ends of the chains (FX25, FX18)."""
    moved = chains.resolve_chains(chained_moves(spark, sf)).remap(_t(spark, sf, "lineitem").select("l_partkey"), "l_partkey")
    return moved.groupBy(F.col("l_partkey").alias("part_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def q70_maps_in_sequence(spark, sf):
    """Three stage maps as one (FX25)."""
    return chains.compose_in_sequence(stage_maps(spark, sf))


def _block_diff(spark, before, after, key, depth=2):
    roots = [scratch_path(spark, name) for name in ("digested-before", "digested-after")]
    for df, root in zip((before, after), roots):
        digests.write_digested(df, root, key, depth)
    return digests.compare_digested(spark, *roots, key)


def q71_block_diff(spark, sf):
    """The rows in which a dimension differs before and after cleaning, from unlike blocks only (QC37)."""
    merge = part_merge(spark, sf)
    return _block_diff(spark, merge.mapping.select("id", "nm"), merge.dimension(), ["id"]).changes


def q72_block_diff_with_schema_drift(spark, sf):
    """Block diff where a column was added, one dropped, and a key is NULL (QC37)."""
    return _block_diff(spark, *drifted_suppliers(spark, sf), ["id"], depth=1).changes


def q73_block_diff_summary(spark, sf):
    """Changes per kind between two order snapshots with few changes; blocks that are alike are counted unread (QC37)."""
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    after = (orders.where(F.col("o_orderkey") % 4999 != 7)
             .withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3001 == 5, F.lit("X")).otherwise(F.col("o_orderstatus"))))
    return _block_diff(spark, orders, after, ["o_orderkey"]).summary()


def bucketed_star(spark, sf) -> dict[str, bucketed.BucketedTable]:
    """Line items (a third of them of one part), cleaned parts and the moves between them, bucketed by the part key."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 3 == 0, F.lit(2).cast("bigint")).otherwise(
        F.col("l_partkey")).alias("l_partkey"))
    merge = part_merge(spark, sf)
    return bucketed.write_bucketed({"lineitem": (li, "l_partkey"), "part": (merge.dimension(), "id"), "moves": (merge.moved(), "source_id")},
                                   scratch_path(spark, "bucketed"), buckets=8)


def q74_colocated_orphans(spark, sf):
    """Line items whose part the clean-up removed, joined bucket by bucket (JN5, QC20, QC34)."""
    star = bucketed_star(spark, sf)
    return star["lineitem"].join(star["part"], "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


def q75_colocated_remap(spark, sf):
    """Line items per part after the remap, joined bucket by bucket (SNK4, FX18)."""
    star = bucketed_star(spark, sf)
    moved = bucketed.remap(star["lineitem"], star["moves"], "target_id")
    return moved.groupBy(F.col("l_partkey").alias("part_id")).agg(F.count(F.lit(1)).alias("n_rows"))


def q76_colocated_diff(spark, sf):
    """The dimension before and after cleaning, both bucketed by key (SRC5, QC37)."""
    merge = part_merge(spark, sf)
    sides = bucketed.write_bucketed({"before": (merge.mapping.select("id", "nm"), "id"), "after": (merge.dimension(), "id")},
                                    scratch_path(spark, "bucketed"), buckets=8)
    return bucketed.diff(sides["before"], sides["after"])


def q77_profile_of_appended_parts(spark, sf):
    """Exact counters of a table appended in three parts, merged from the parts' states (QC32, QC33, AG12, QC18)."""
    stored = profile_state.ProfiledTable(spark, scratch_path(spark, "profiled"))
    customers = _v(spark, sf, "dirty_customer")
    for i in range(3):
        stored.append(customers.where(F.col("c_custkey") % 3 == i), f"p{i}")
    return profile_state.counters(stored.profile())


def q78_misspelled_names(spark, sf):
    """Rare part names one edit from a name at least five times as frequent (FLT20, FX7)."""
    return misspellings.misspellings(_v(spark, sf, "typo_names"), "nm", ratio=5)


def q79_name_neighbours(spark, sf):
    """All pairs of part names within two edits (FLT20)."""
    return misspellings.neighbours(misspellings.value_counts(_v(spark, sf, "typo_names"), "nm"), max_distance=2)


def q80_derived_repairs(spark, sf):
    """Garbled sequences of the documents, what they stand for, and the rows that hold them (QC8, FX9-FX13)."""
    return derived_repairs.derive_repairs(_v(spark, sf, "dirty_docs"), "text").drop("kind")


# 500 replacements of customer numbers, made by rule.
NUMBER_REPLACEMENTS = tuple((f"#{i:09d}", f" ({i})") for i in range(500))


def q81_one_pass_replacements(spark, sf):
    """500 replacements in one pass over the names (FX23)."""
    return _t(spark, sf, "customer").select("c_custkey", one_pass.replace_all(F.col("c_name"), NUMBER_REPLACEMENTS).alias("c_name"))


def q82_change_journal(spark, sf):
    """Every change of the ordered supplier repairs, rule by rule (FX24, QC39)."""
    return journal.change_journal(_v(spark, sf, "dirty_supplier").select("id", "nm"), ["id"], supplier_repair_rules())


def q83_rolled_back_repairs(spark, sf):
    """Supplier names after undoing the last repair alone, and after undoing all of them (FX24)."""
    before = _v(spark, sf, "dirty_supplier").select("id", "nm")
    path = scratch_path(spark, "journalled")
    journal.write_with_journal(rules.apply_rules(before, supplier_repair_rules()),
                               journal.change_journal(before, ["id"], supplier_repair_rules()), path, "supplier")
    after, log = journal.read_with_journal(spark, path, "supplier")
    last = journal.roll_back(after, log, ["id"], rules=["suffix_case"]).rows
    return last.select(F.lit("last").alias("undone"), "*").unionByName(journal.roll_back(after, log, ["id"]).rows.select(F.lit("all").alias("undone"), "*"))


def q84_null_association(spark, sf):
    """Whether missing balances and missing segments go with the customer's nation: systematic or random? (QC26)"""
    customers = _v(spark, sf, "dirty_customer").withColumn(
        "c_mktsegment", F.when(F.col("c_nationkey") < 5, F.lit(None)).otherwise(F.col("c_mktsegment")))
    parts = [profile.null_association(customers, "c_nationkey", c).select(F.lit(c).alias("column_name"), "n_members", "n_rows", "n_null",
             F.round("chi_square", 6).alias("chi_square"), "degrees_of_freedom", F.round("cramers_v", 6).alias("cramers_v"))
             for c in ("c_acctbal", "c_mktsegment")]
    return parts[0].unionByName(parts[1])


def q85_code_point_discovery_of_names(spark, sf):
    """First artifacts of the names with the least name as example (QC8, AG11)."""
    return profile.first_artifact_discovery(_v(spark, sf, "dirty_supplier"), "nm", width=3)


def q86_full_preview(spark, sf):
    """A whole table as it is (PRJ1)."""
    return _t(spark, sf, "supplier")


def q87_incremental_merge(spark, sf):
    """A kept survivor map after a change of some members and the removal of others (FX18, FX21)."""
    part = _v(spark, sf, "dirty_part")
    kept = incremental_merge.kept_merge(spark, scratch_path(spark, "kept-merge"), part, "id", "nm", placeholder=PART_PLACEHOLDER)
    kept.update(part.where(F.col("id") % 97 == 5).select("id", F.concat(F.lit("new "), "nm").alias("nm")), part.where(F.col("id") % 89 == 7).select("id"))
    return kept.mapping().select("id", F.col("_cls").alias("member_class"), F.col("_key").alias("member_key"), F.col("_target").alias("target_id"))


COLLATED_SPECS = {
    "names": TableSpec("names", T.StructType([T.StructField("name", T.StringType())]), ("name",), collations=(("name", CASE_AND_TRAILING_BLANKS),)),
    "refs": TableSpec("refs", T.StructType([T.StructField("id", T.LongType()), T.StructField("ref", T.StringType())]), ("id",),
                      (ForeignKey("ref", "names", "name"),), collations=(("ref", CASE_AND_TRAILING_BLANKS),)),
}


def collated_tables(spark, sf) -> dict[str, DataFrame]:
    """Part names, some missing, and references to them in other letter case and with blanks at the end."""
    pv = _v(spark, sf, "part_variants")
    ref = F.when(F.col("id") % 2 == 0, F.concat(F.lower("nm"), F.lit("  "))).otherwise(F.col("nm"))
    return {"names": pv.where(F.col("nm") < "n").select(F.col("nm").alias("name")).distinct(), "refs": pv.select("id", ref.alias("ref"))}


def q88_collated_constraints(spark, sf):
    """Declared keys and references under a collation without letter case and trailing blanks (FLT16, SRC4)."""
    return checks.spec_report(collated_tables(spark, sf), COLLATED_SPECS)


def q89_collated_merge(spark, sf):
    """Members whose names are equal under the declared collation, merged; survivors keep their spelling (FLT16, FX18)."""
    refs = COLLATED_SPECS["refs"].collated(collated_tables(spark, sf)["refs"])
    merge = dimension.plan_dimension_merge(refs, "id", "ref", placeholder={"id": -1, "ref": "N/A"})
    return merge.mapping.select("id", F.collate("ref", "UTF8_BINARY").alias("ref"), F.col("_target").alias("target_id"))


def q90_export_with_byte_order_mark(spark, sf):
    """The exported file's lines in order, with the mark at its start (SNK1)."""
    path = scratch_path(spark, "marked-csv")
    marked_csv.export_marked_csv(_t(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"), path, ["s_suppkey"])
    parts = spark.read.format("binaryFile").load(f"{path}/part-*.csv").select(
        F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("part"), F.decode("content", "UTF-8").alias("content"))
    lines = parts.select("part", F.posexplode(F.split(F.regexp_replace("content", "\n$", ""), "\n")).alias("line", "value"))
    return lines.select((F.row_number().over(Window.orderBy("part", "line")) - 1).cast("int").alias("line"), "value")  # a check of a small export


QUERIES: dict[str, Query] = {
    name: fn for name, fn in sorted(globals().items()) if name[:1] == "q" and name[1:3].isdigit()
}
