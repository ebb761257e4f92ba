"""Text to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.scalars import epoch_ts

MB = 1_048_576
KB = 1024


def parse_json(df: DataFrame, raw: str, schema: str, keep: Mapping[str, str] | Sequence[str] = ()) -> DataFrame:
    """All fields of the JSON text as top-level columns, plus kept (and renamed) ones.

    Broken text gives a row of NULLs, so a not-NULL rule on the key removes it.

    The record is unpacked by a generator.  Rules on its fields then run on the unpacked row;
    over a plain projection Spark would move them below it and parse every text once more
    per rule.
    """
    keep = keep if isinstance(keep, Mapping) else {c: c for c in keep}
    parsed = F.inline(F.array(F.from_json(raw, schema)))
    return df.select(parsed, *[F.col(c).alias(out) for c, out in keep.items()])


def pick_json(df: DataFrame, raw: str, schema: str, picks: Mapping[str, str], keep: Mapping[str, str]) -> DataFrame:
    """Chosen fields under new names, as SQL over the payload fields.  Rows whose payload is
    NULL are left out."""
    parsed = parse_json(df.filter(F.col(raw).isNotNull()), raw, schema, keep)
    return parsed.select(*[F.expr(text).alias(out) for out, text in picks.items()], *keep.values())


# JSON kinds, as Spark names a variant's schema, that may stand where a column of the type is expected.
_KINDS = {
    **dict.fromkeys(("tinyint", "smallint", "int", "bigint"), "^BIGINT$"),
    **dict.fromkeys(("float", "double", "decimal"), "^(BIGINT|DECIMAL|FLOAT|DOUBLE)"),
    **dict.fromkeys(("date", "timestamp", "timestamp_ntz"), "^STRING$"),
    "boolean": "^BOOLEAN$",
}


def rescue_fields(df: DataFrame, raw: str, schema: str, keep: Sequence[str] = (), rescued: str = "_rescued_data") -> DataFrame:
    """Fields of a JSON object by ``schema``; only what does not fit goes to ``rescued``, as JSON.

    The text is parsed once, into variants by field.  A field fits if it is null or of a kind
    its column can hold without a change of meaning (text is never read as a number), a nested
    one if it comes back the same; every other one, and every field the schema does not name, is rescued with its own value, in the
    order of the text.  Text that is no JSON object is rescued whole.  Expressions alone, so
    batch and stream agree.
    """
    fields = StructType.fromDDL(schema).fields

    def fits(v: str, kind: str) -> str:
        shape, value = _KINDS.get(kind.split("(")[0]), f"try_variant_get({v}, '$', '{kind}')"
        ok = f"{value} IS NOT NULL" + (f" AND schema_of_variant({v}) RLIKE '{shape}'" if shape else "")
        if "<" in kind:  # whatever does not come back the same was no such array, map or struct
            ok += f" AND to_json({value}) = to_json({v})"
        return f"({v} IS NULL OR is_variant_null({v}) OR ({ok}))"

    named = [(f.name.replace("'", "\\'"), f.name, f.dataType.simpleString()) for f in fields]
    judged = " ".join(f"WHEN '{text}' THEN NOT {fits('v', kind)}" for text, _, kind in named)
    parsed = df.withColumn("_fields", F.expr(f"from_json(`{raw}`, 'map<string,variant>')"))
    values = [
        F.expr(f"CASE WHEN {fits(v, kind)} THEN try_variant_get({v}, '$', '{kind}') END").alias(name)
        for text, name, kind in named for v in [f"_fields['{text}']"]
    ]
    odd = f"map_filter(_fields, (k, v) -> CASE k {judged} ELSE true END)"
    whole = f"CASE WHEN _fields IS NULL THEN `{raw}` WHEN size({odd}) > 0 THEN to_json({odd}) END"
    return parsed.select(*values, F.expr(whole).alias(rescued), *keep)


def epoch_columns(df: DataFrame, columns: Sequence[str], drop: bool = True) -> DataFrame:
    """``x`` in epoch seconds becomes ``x_ts``."""
    out = df.withColumns({f"{c}_ts": epoch_ts(c) for c in columns})
    return out.drop(*columns) if drop else out


def register(raw: str, divisor: int = 1) -> Column:
    """Raw register text to a number.  Text that is no integer gives NULL, not an error."""
    value = F.col(raw).try_cast("int")
    return value if divisor == 1 else value / F.lit(float(divisor))


def register_diff(raw: str, minus: str, divisor: int) -> Column:
    """Difference taken on the integers, so that no rounding error enters."""
    return (F.col(raw).try_cast("int") - F.col(minus).try_cast("int")) / F.lit(float(divisor))


def local_timestamp(day: str, time: str) -> Column:
    """Local wall-clock time without a zone; NULL where the text is no time."""
    return F.concat_ws(" ", day, time).try_cast("timestamp_ntz")
