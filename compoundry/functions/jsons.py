"""JSON columns: F17, F20-F22, F24."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import strip_ws

FIRST_PROPERTY = "struct<CID:bigint,MolecularFormula:string,MolecularWeight:string,IUPACName:string,_raw:string>"


def _path(key: str) -> str:
    return "$['" + key.replace("'", "\\'") + "']"


def json_text(c: Column, key: str, dtype: str = "string") -> Column:
    """one key as text, blank as NULL, optionally cast; a bad value gives NULL."""
    text = F.nullif(F.get_json_object(c, _path(key)), F.lit(""))
    return text if dtype == "string" else text.try_cast(dtype)


def json_text_array(c: Column, key: str) -> Column:
    """a JSON array as text array; missing gives an empty array."""
    parsed = F.from_json(c, f"struct<`{key}`:array<string>>")
    return F.coalesce(parsed[key], F.array().cast("array<string>"))


def json_each_text(df: DataFrame, column: str) -> DataFrame:
    """one row per key of a JSON object, next to the columns of the row."""
    return df.select("*", F.explode(F.from_json(F.col(column), "map<string,string>")).alias("key", "value"))


def first_property(payload: Column) -> Column:
    """the first property entry of a lookup payload; NULL when there is none."""
    schema = (
        "struct<PropertyTable:struct<Properties:array<struct<CID:bigint,MolecularFormula:string,"
        "MolecularWeight:string,IUPACName:string>>>>"
    )
    first = F.get(F.from_json(payload, schema)["PropertyTable"]["Properties"], F.lit(0))
    return F.when(
        first.isNotNull(),
        F.struct(
            first["CID"].alias("CID"),
            first["MolecularFormula"].alias("MolecularFormula"),
            first["MolecularWeight"].alias("MolecularWeight"),
            first["IUPACName"].alias("IUPACName"),
            payload.alias("_raw"),
        ),
    )


def is_json_object(c: Column) -> Column:
    """True for text that parses as one JSON object."""
    schema = T.StructType([T.StructField("_bad", T.StringType())])
    parsed = F.from_json(c, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    braced = strip_ws(c).startswith("{") & strip_ws(c).endswith("}")
    return c.isNotNull() & braced & parsed["_bad"].isNull()


def _safe(c: Column, dtype: T.DataType) -> Column:
    """A value that ``to_json`` writes as valid JSON; the structure is walked by type, not by row."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        d = c.cast("double")
        return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)
    if isinstance(dtype, T.DecimalType):
        return c.cast("double")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        micros = F.date_format(c, ".SSSSSS")
        zone = F.date_format(c, "xxx") if isinstance(dtype, T.TimestampType) else F.lit("")
        return F.concat(whole, F.when(micros != ".000000", micros).otherwise(""), zone)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _safe(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(
            F.transform_keys(c, lambda k, v: k.cast("string")), lambda k, v: _safe(v, dtype.valueType)
        )
    if isinstance(dtype, T.StructType):
        fields = F.struct(*[_safe(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(c.isNotNull(), fields)
    if isinstance(dtype, (T.StringType, T.BooleanType, T.IntegralType)):
        return c
    return c.cast("string")


def sanitize(df: DataFrame) -> DataFrame:
    """every column in a form that JSON can carry (no NaN or infinity, ISO dates, plain numbers)."""
    return df.select(*[_safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def row_json(df: DataFrame, *columns: str) -> Column:
    """Columns of a row as one JSON object, NULLs kept."""
    names = columns or tuple(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.to_json(
        F.struct(*[_safe(F.col(f"`{n}`"), types[n]).alias(n) for n in names]), {"ignoreNullFields": "false"}
    )
