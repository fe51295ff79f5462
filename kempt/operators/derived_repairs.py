"""Encoding repairs worked out from the data: which garbled sequences stand for what.

Text written as UTF-8 and read as Windows-1252 shows a lead character from the
range of UTF-8 lead bytes, followed by as many characters as that lead byte
announces.  Every such sequence can be turned back into its bytes and decoded.
The sequences of each row are found by one pattern, counted by the rows they
stand in, and decoded once per distinct sequence, however many rows hold it.

A lead character of a no-break space that lost its second byte (or two of them
around a plus sign) stands for a space.  All steps are built-in functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kempt.operators.rules import Rule, replace_rule

#: What Windows-1252 shows for the bytes 0x80 to 0x9F; it has no character for 81, 8D, 8F, 90 and 9D.
_SHOWN = {byte: bytes([byte]).decode("cp1252") for byte in range(0x80, 0xA0) if byte not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
_TAIL = "[\u0080-¿" + "".join(_SHOWN.values()) + "]"
#: The lead of a lost no-break space, on both sides of a plus sign or alone, then sequences of two to four characters.
ARTIFACT = (f"Â\\+Â(?!{_TAIL})|Â(?!{_TAIL})|[Â-ß]{_TAIL}|[à-ï]{_TAIL}{{2}}|[ð-ô]{_TAIL}{{3}}")
DECODED, LOST_SPACE = "decoded", "lost_space"


def original_bytes(artifact: Column) -> Column:
    """The bytes that were read as Windows-1252."""
    return F.encode(F.translate(artifact, "".join(_SHOWN.values()), "".join(map(chr, _SHOWN))), "ISO-8859-1")


def artifact_counts(df: DataFrame, column: str) -> DataFrame:
    """``(artifact, affected_rows)``: a row counts once for each of its sequences; partial counts before the shuffle."""
    found = F.array_distinct(F.regexp_extract_all(F.col(column), F.lit(ARTIFACT), F.lit(0)))
    return df.select(F.explode(found).alias("artifact")).groupBy("artifact").agg(F.count(F.lit(1)).alias("affected_rows"))


def derive_repairs(df: DataFrame, column: str, *, least_rows: int = 1) -> DataFrame:
    """``(artifact, repair, kind, affected_rows)`` of every sequence that at least ``least_rows`` rows hold.

    Sequences whose bytes are no valid UTF-8 (surrogates, overlong forms) have
    no repair and are left out.  Order it by ``affected_rows`` to see what a
    repair would change before it is made a rule.
    """
    counts = artifact_counts(df, column).where(F.col("affected_rows") >= least_rows)
    lost = F.col("artifact").startswith("Â") & F.col("artifact").endswith("Â")
    decoded = original_bytes(F.col("artifact")).cast("string")
    repair = F.when(lost, F.translate("artifact", "Â", " ")).when(F.is_valid_utf8(decoded), decoded)
    return (counts.select("artifact", repair.alias("repair"), F.when(lost, F.lit(LOST_SPACE)).otherwise(F.lit(DECODED)).alias("kind"), "affected_rows")
            .where("repair is not null"))


def as_rules(repairs: DataFrame, column: str, most: int = 500) -> list[Rule]:
    """The ``most`` repairs that change the most rows as replace rules, longer sequences first.

    The driver holds ``most`` rows; there are at most some thousand distinct
    sequences, as every one stands for one character.
    """
    chosen = repairs.orderBy(F.desc("affected_rows"), "artifact").limit(most).select("artifact", "repair").collect()
    return as_rule_list([(r["artifact"], r["repair"]) for r in chosen], column)


def as_rule_list(pairs: Sequence[tuple[str, str]], column: str) -> list[Rule]:
    """Replace rules in an order in which no rule breaks a longer sequence."""
    ordered = sorted(pairs, key=lambda p: (-len(p[0]), p[0]))
    return [replace_rule(f"decode {a}", column, a, b) for a, b in ordered]
