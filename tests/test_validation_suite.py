"""The documented validation rows for the fact tables, as a kempt validation job.

Fixtures are generated by rule with the documented counts (the source snapshots
are not available): Medicine 21,708 rows with 214 / 849 / 147 NULL Generic_ID /
Strength / Manufacturer_ID and 59 carried-forward duplicate rows; PackageSize
14,349 rows with one duplicate group; PackageContainer 22,707 rows in three
formats (13,496 without size, 9,172 with both, 39 without price), three
duplicate groups and three 'N/A' container types.  The job computes every
check with fused aggregates, compares it with the expectations (documented
exceptions carry a note) and must pass; all foreign keys must be intact.
"""

from pyspark.sql import functions as F

from kempt.operators import checks, profile, report

N_MED, N_SIZE, N_CONT = 21708, 14349, 22707
FORMATS = ("Format B — unit-priced", "Format Mixed — both populated",
           "Format Placeholder — no pricing", "Empty — both NULL")


def fixtures(spark):
    null_gen = set(range(100, 21401, 100))                 # 214
    null_str = set(range(3, 3 + 849 * 25, 25))             # 849
    null_man = set(range(7, 7 + 147 * 100, 100))           # 147
    med = []
    for i in range(1, N_MED + 1):
        src = i - 59 if N_MED - 59 < i else i              # the last 59 rows are twins of earlier rows
        med.append((i, f"Brand {src}", "allopathic", src % 113 + 1,
                    None if src in null_gen else src % 1711 + 1,
                    None if src in null_str else f"{src % 50 + 1} mg",
                    None if src in null_man else src % 240 + 1))
    medicine = spark.createDataFrame(med, "Brand_ID int, Brand_Name string, Type string, Dosage_Form_ID int, "
                                          "Generic_ID int, Strength string, Manufacturer_ID int")
    sizes = [(i, i if i < N_SIZE - 2 else N_SIZE - 2, 10, 100.0) for i in range(1, N_SIZE + 1)]
    pack_size = spark.createDataFrame(sizes, "PackageSize_ID int, Brand_ID int, Pack_Size int, Pack_Price double") \
        .withColumn("Pack_Price", F.col("Pack_Price").cast("decimal(10,2)"))
    cont = []
    for i in range(1, N_CONT + 1):
        brand = (i % N_MED) + 1
        if i <= 13496:
            size, price = None, 5.0 + i % 7
        elif i <= 13496 + 9172:
            size, price = f"{i % 9 + 1} ml bottle", 1.0 + i % 5
        else:
            size, price = "Not for sale", None
        cont.append([i, brand, size, price, "N/A" if i in (20001, 20002, 20003) else "bottle"])
    for dup, twin in ((22001, 22000), (21001, 21000), (20501, 20500)):   # three duplicate groups
        cont[dup - 1][1:4] = cont[twin - 1][1:4]
    container = spark.createDataFrame([tuple(r) for r in cont],
                                      "PackageContainer_ID int, Brand_ID int, Container_Size string, "
                                      "Unit_Price double, Container_Type string") \
        .withColumn("Unit_Price", F.col("Unit_Price").cast("decimal(10,2)"))
    parents = {
        "Dosage_Form": spark.range(1, 114).select(F.col("id").cast("int").alias("Dosage_Form_ID")),
        "Generic": spark.range(1, 1712).select(F.col("id").cast("int").alias("Generic_ID")),
        "Manufacturer": spark.range(1, 241).select(F.col("id").cast("int").alias("Manufacturer_ID")),
    }
    return medicine, pack_size, container, parents


def test_fact_table_validation_rows(spark):
    med, size, cont, parents = fixtures(spark)
    null = checks.null_count
    actual = [
        checks.to_long(checks.run_checks(med, {
            "medicine.total_rows": checks.row_count(), "medicine.null_brand_name": null("Brand_Name"),
            "medicine.null_type": null("Type"), "medicine.null_dosage_form_id": null("Dosage_Form_ID"),
            "medicine.null_generic_id": null("Generic_ID"), "medicine.null_strength": null("Strength"),
            "medicine.null_manufacturer_id": null("Manufacturer_ID"),
            "medicine.encoding_issues": checks.non_ascii_count("Brand_Name")})),
        checks.to_long(checks.run_checks(size, {
            "pack_size.total_rows": checks.row_count(), "pack_size.null_pack_size": null("Pack_Size"),
            "pack_size.null_pack_price": null("Pack_Price")})),
        checks.to_long(checks.run_checks(cont, {
            "container.total_rows": checks.row_count(), "container.null_container_size": null("Container_Size"),
            "container.null_unit_price": null("Unit_Price"), "container.null_container_type": null("Container_Type"),
            "container.na_container_type": checks.count_where(F.col("Container_Type") == "N/A")})),
    ]
    dups = {
        "medicine.duplicate_rows": checks.duplicate_summary(checks.duplicate_groups(
            med, ["Brand_Name", "Strength", "Dosage_Form_ID", "Generic_ID", "Manufacturer_ID"])),
        "pack_size.duplicate_groups": checks.duplicate_summary(checks.duplicate_groups(
            size, ["Brand_ID", "Pack_Size", "Pack_Price"])),
        "container.duplicate_groups": checks.duplicate_summary(checks.duplicate_groups(
            cont, ["Brand_ID", "Container_Size", "Unit_Price"])),
    }
    for name, summ in dups.items():
        col = "duplicate_rows" if name == "medicine.duplicate_rows" else "duplicate_groups"
        value = F.col(col) - F.col("duplicate_groups") if col == "duplicate_rows" else F.col(col)
        actual.append(summ.select(F.lit(name).alias("check_name"), value.cast("bigint").alias("actual")))
    actual.append(checks.groups_over_bound(size, ["Brand_ID"], 3).select(
        F.lit("pack_size.brands_over_3_sizes").alias("check_name"), F.col("groups_over_bound").alias("actual")))
    actual_df = actual[0]
    for a in actual[1:]:
        actual_df = actual_df.unionByName(a)

    exp = report.expectations(spark, [
        ("medicine.total_rows", 21708, "row count"), ("medicine.null_brand_name", 0, None),
        ("medicine.null_type", 0, None), ("medicine.null_dosage_form_id", 0, None),
        ("medicine.null_generic_id", 214, "accepted: missing generic"),
        ("medicine.null_strength", 849, "accepted: strength not applicable"),
        ("medicine.null_manufacturer_id", 147, "accepted: missing manufacturer"),
        ("medicine.encoding_issues", 0, None),
        ("medicine.duplicate_rows", 59, "carried forward from the upstream load"),
        ("pack_size.total_rows", 14349, "row count"), ("pack_size.null_pack_size", 0, None),
        ("pack_size.null_pack_price", 0, None), ("pack_size.duplicate_groups", 1, "upstream triplicate"),
        ("pack_size.brands_over_3_sizes", 0, None),
        ("container.total_rows", 22707, "row count"), ("container.null_container_size", 13496, "format B"),
        ("container.null_unit_price", 39, "placeholder rows"), ("container.null_container_type", 0, None),
        ("container.duplicate_groups", 3, "upstream duplicates"), ("container.na_container_type", 3, "no keyword"),
    ])
    result = report.validate(actual_df, exp)
    report.assert_valid(result)
    assert result.where(F.col("status") == report.EXCEPTION).count() == 12

    label = profile.classify_null_pattern(F.col("Container_Size"), F.col("Unit_Price"), FORMATS)
    formats = {r[0]: r[1] for r in cont.groupBy(label).count().collect()}
    assert formats == {FORMATS[0]: 13496, FORMATS[1]: 9172, FORMATS[2]: 39}

    rels = [checks.Relation("medicine -> dosage_form", med, "Dosage_Form_ID", parents["Dosage_Form"],
                            "Dosage_Form_ID", optional=True),
            checks.Relation("medicine -> generic", med, "Generic_ID", parents["Generic"], "Generic_ID", optional=True),
            checks.Relation("medicine -> manufacturer", med, "Manufacturer_ID", parents["Manufacturer"],
                            "Manufacturer_ID", optional=True),
            checks.Relation("pack_size -> medicine", size, "Brand_ID", med, "Brand_ID"),
            checks.Relation("container -> medicine", cont, "Brand_ID", med, "Brand_ID")]
    assert {r["check_name"]: r["issue_count"] for r in checks.integrity_report(rels).collect()} == \
        {r.name: 0 for r in rels}
