"""Declared schemas, looked up by name, and schema comparison."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, AtomicType, DataType, MapType, StructField, StructType

# Field names, types and which fields are required.
_DDL = {
    "customers": (
        "customer_id int not null, name string not null, age int, city string,"
        " salary decimal(10,2), department string"
    ),
    "orders": (
        "order_id int not null, customer_id int not null, product_name string not null,"
        " quantity int not null, price decimal(10,2) not null, order_date date, status string"
    ),
    "user_activity": (
        "timestamp timestamp not null, user_id int not null, action string not null,"
        " product string, value decimal(10,2)"
    ),
    "user_activity_raw": (
        "timestamp string not null, user_id int not null, action string not null,"
        " product string, value decimal(10,2)"
    ),
    "transactions": (
        "event_time timestamp not null, user_id int not null, product_id string not null,"
        " amount decimal(10,2) not null, city string"
    ),
    "transactions_raw": (
        "event_time string not null, user_id int not null, product_id string not null,"
        " amount decimal(10,2) not null, city string"
    ),
    "live_data": (
        "timestamp timestamp not null, user_id int not null, action string not null,"
        " value decimal(10,2), session_id string not null"
    ),
    "live_data_raw": (
        "timestamp string not null, user_id int not null, action string not null,"
        " value decimal(10,2), session_id string not null"
    ),
    "web_events": (
        "timestamp timestamp not null, user_id int not null, session_id string not null,"
        " event_type string not null, page string, duration_ms int"
    ),
    "sales": (
        "sale_id bigint not null, product_id string not null, customer_id int not null,"
        " sale_date date not null, sale_timestamp timestamp not null, quantity int not null,"
        " unit_price decimal(10,2) not null, total_amount decimal(12,2) not null,"
        " discount decimal(5,2), region string, store_id string"
    ),
    "nested": (
        "id int not null,"
        " user_info struct<user_id: int not null, name: string not null, email: string,"
        " preferences: struct<notifications: boolean, theme: string, language: string>> not null,"
        " orders array<struct<order_id: int not null,"
        " items: array<struct<product_id: string not null, quantity: int not null,"
        " price: decimal(10,2) not null>> not null,"
        " order_date: timestamp not null, total: decimal(12,2) not null>>,"
        " metadata map<string,string>"
    ),
}

# Which declared schema each kind of file has. Streamed kinds arrive raw.
_FILE_KINDS = {
    "customers": "customers",
    "orders": "orders",
    "user_activity": "user_activity_raw",
    "transactions": "transactions_raw",
    "live_data": "live_data_raw",
    "sales": "sales",
    "nested": "nested",
}


@cache
def declared(name: str) -> StructType:
    """The schema of that name; each is built when first asked for."""
    return StructType.fromDDL(_DDL[name])


def declared_names() -> list[str]:
    return list(_DDL)


def for_file_kind(kind: str) -> StructType | None:
    name = _FILE_KINDS.get(kind)
    return declared(name) if name else None


@dataclass(frozen=True)
class SchemaDiff:
    """Differences of a second schema from a first."""

    missing_fields: list[str] = field(default_factory=list)
    extra_fields: list[str] = field(default_factory=list)
    type_mismatches: list[str] = field(default_factory=list)
    nullability_differences: list[str] = field(default_factory=list)

    @property
    def same_types(self) -> bool:
        return not (self.missing_fields or self.extra_fields or self.type_mismatches)


def relaxed(kind: DataType) -> DataType:
    """The type with nulls allowed at every depth, as file scans report it."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, relaxed(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(relaxed(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(relaxed(kind.keyType), relaxed(kind.valueType))
    return kind


def _lacking(value: Column, kind: DataType) -> Column:
    """Whether a value lacks a required member at any depth; a null value lacks nothing itself."""
    out = F.lit(False)
    if isinstance(kind, StructType):
        for f in kind.fields:
            member = value[f.name]
            out = out | (value.isNotNull() & (member.isNull() if not f.nullable else F.lit(False))) | _lacking(member, f.dataType)
    elif isinstance(kind, ArrayType) and not isinstance(kind.elementType, AtomicType):
        out = F.coalesce(F.exists(value, lambda x: _lacking(x, kind.elementType)), F.lit(False))
    return out


def diff(first: StructType, second: StructType) -> SchemaDiff:
    a = {f.name: f for f in first.fields}
    b = {f.name: f for f in second.fields}
    both = [name for name in a if name in b]
    return SchemaDiff(
        missing_fields=[name for name in a if name not in b],
        extra_fields=[name for name in b if name not in a],
        type_mismatches=[
            f"{n}: {a[n].dataType} vs {b[n].dataType}" for n in both if relaxed(a[n].dataType) != relaxed(b[n].dataType)
        ],
        nullability_differences=[
            f"{n}: {a[n].nullable} vs {b[n].nullable}" for n in both if a[n].nullable != b[n].nullable
        ],
    )


def diff_frame(spark: SparkSession, first: StructType, second: StructType) -> DataFrame:
    """The same differences as rows (kind, detail)."""
    found = diff(first, second)
    rows = [(kind, detail) for kind in SchemaDiff.__dataclass_fields__ for detail in getattr(found, kind)]
    return spark.createDataFrame(rows, "kind string, detail string")


def null_counts(df: DataFrame, expected: StructType) -> dict[str, int]:
    """Rows that lack a required field, nested ones included, by top field and in one pass."""
    checks = {}
    for f in expected.fields:
        if f.name in df.columns:
            lacks = _lacking(F.col(f.name), f.dataType)
            checks[f.name] = lacks if f.nullable else F.col(f.name).isNull() | lacks
    if not checks:
        return {}
    counts = df.agg(*[F.count_if(lacks).alias(c) for c, lacks in checks.items()]).first()
    return {c: counts[c] for c in checks if counts[c]}


def required(df: DataFrame, expected: StructType, row: Column) -> DataFrame:
    """``df`` as it is, but a row that lacks a required field, at any depth, stops the job with the field and ``row``, which names it.

    The requirement is part of the plan: no second pass, whatever the size. Rows that the plan drops before are
    not looked at. Columns that ``expected`` does not have are let through; those it has must be there.
    """
    missing = [f.name for f in expected.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    checks = []
    for f in expected.fields:
        value = F.col(f"`{f.name}`")
        lacks = _lacking(value, f.dataType)
        if not f.nullable:
            checks.append(F.when(value.isNull(), F.lit(f.name)))
        checks.append(F.when(F.coalesce(lacks, F.lit(False)), F.lit(f"a member of {f.name}")))
    lacking = F.coalesce(*checks, F.lit(None).cast("string"))
    message = F.concat(F.lit("required field is null: "), lacking, F.lit(", row "), F.coalesce(row.cast("string"), F.lit("without a name")))
    return df.filter(F.when(lacking.isNotNull(), F.raise_error(message)).otherwise(F.lit(True)))


def matches(df: DataFrame, expected: StructType) -> bool:
    """Same names and types, and no null in a required field.

    File scans always report nullable columns, so nullability is tested on the data.
    """
    return diff(expected, df.schema).same_types and not null_counts(df, expected)


def conform(df: DataFrame, expected: StructType) -> DataFrame:
    """Reorder and cast to the declared schema."""
    relaxed = StructType([type(f)(f.name, f.dataType, True) for f in expected.fields])
    return df.to(relaxed)


def describe(schema: StructType, title: str = "Schema") -> str:
    lines = [f"  {f.name}: {f.dataType.simpleString()}{'' if f.nullable else ' not null'}" for f in schema.fields]
    return "\n".join([title, *lines])
