"""Column catalogs: one row per column of every table.

A catalog holds metadata only. Its size is that of the schema, not of the data, so
compiling it on the driver is bounded by the number of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import ColumnSpec, TableSchema

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("precision", T.IntegerType()),
        T.StructField("scale", T.IntegerType()),
        T.StructField("unsigned", T.BooleanType()),
        T.StructField("nullable", T.BooleanType()),
        T.StructField("pk_pos", T.IntegerType()),
        T.StructField("default_value", T.StringType()),
    ]
)

_COLUMNS_SQL = """
SELECT table_name, column_name, ordinal_position AS ordinal, data_type,
       numeric_precision AS num_precision, numeric_scale AS num_scale, {full_type} AS full_type,
       is_nullable, column_default AS default_value
FROM information_schema.columns WHERE table_schema = '{database}'
"""
_KEYS_SQL = """
SELECT k.table_name, k.column_name, k.ordinal_position AS pk_pos
FROM information_schema.table_constraints c
JOIN information_schema.key_column_usage k
  ON k.constraint_schema = c.constraint_schema
 AND k.constraint_name = c.constraint_name AND k.table_name = c.table_name
WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = '{database}'
"""


# Marks a default that is an expression whose value only the database knows.
UNREADABLE = "unreadable default: "


def plain_default(default: Column, dialect: str) -> Column:
    """A column default as a plain value.

    PostgreSQL writes defaults as expressions: casts and quotes go, the current time gets one name, and
    any other call is marked unreadable. MySQL writes values.
    """
    if dialect == "mysql":
        return default
    bare = F.regexp_replace(F.trim(default), r"(?s)^(.*?)(::[a-z][a-z0-9_ ]*(\([0-9, ]*\))?(\[\])?)+$", "$1")
    bare = F.regexp_replace(bare, r"^\((-?[0-9.]+)\)$", "$1")
    return (
        F.when(bare.rlike(r"(?s)^'.*'$"), F.replace(_inside(bare), F.lit("''"), F.lit("'")))
        .when(F.upper(bare) == "NULL", F.lit(None).cast("string"))
        .when(bare.rlike(r"(?i)^(now\(\)|current_timestamp(\([0-9]*\))?|localtimestamp(\([0-9]*\))?|transaction_timestamp\(\))$"), F.lit("CURRENT_TIMESTAMP"))
        .when(bare.rlike(r"(?i)^(-?[0-9.]+|true|false)$"), bare)
        .otherwise(F.concat(F.lit(UNREADABLE), default))
    )


def _inside(quoted: Column) -> Column:
    return quoted.substr(F.lit(2), F.length(quoted) - 2)


def read_database_catalog(spark: SparkSession, url: str, database: str, dialect: str, **options: str) -> DataFrame:
    """Catalog of a live database, from its information schema."""
    full_type = "column_type" if dialect == "mysql" else "data_type"

    def query(sql: str) -> DataFrame:
        text = sql.format(database=database.replace("'", "''"), full_type=full_type)
        frame = spark.read.format("jdbc").options(url=url, query=text, **options).load()
        return frame.toDF(*[c.lower() for c in frame.columns])

    columns = query(_COLUMNS_SQL).select(
        "table_name",
        "column_name",
        F.col("ordinal").cast("int").alias("ordinal"),
        F.lower("data_type").alias("data_type"),
        F.col("num_precision").cast("int").alias("precision"),
        F.col("num_scale").cast("int").alias("scale"),
        F.lower("full_type").contains("unsigned").alias("unsigned"),
        (F.upper("is_nullable") == "YES").alias("nullable"),
        plain_default(F.col("default_value"), dialect).alias("default_value"),
    )
    keys = query(_KEYS_SQL).groupBy("table_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pk_pos", "column_name"))), lambda k: k.column_name).alias(
            "key_columns"
        )
    )
    return build_catalog(columns, keys)


def build_catalog(columns: DataFrame, keys: DataFrame) -> DataFrame:
    """Join columns to the ordered key column list of their table.

    Names are matched, and kept, in lower case; tables without a key have no ``pk_pos``.
    """
    positions = keys.select(F.lower("table_name").alias("table_name"), F.posexplode("key_columns")).select(
        "table_name", F.lower("col").alias("column_name"), (F.col("pos") + 1).alias("pk_pos")
    )
    return (
        columns.withColumns({"table_name": F.lower("table_name"), "column_name": F.lower("column_name")})
        .join(positions, ["table_name", "column_name"], "left")
        .select(*CATALOG_SCHEMA.fieldNames())
        .orderBy("table_name", "ordinal")
    )


def catalog_of(spark: SparkSession, tables: list[TableSchema]) -> DataFrame:
    """Catalog rows of tables declared in code."""
    rows = [
        (t.table, c.name, c.ordinal or i, c.data_type, c.precision, c.scale, c.unsigned, c.nullable, c.pk_pos, c.default)
        for t in tables
        for i, c in enumerate(t.columns, 1)
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def compile_catalog(catalog: DataFrame) -> dict[str, TableSchema]:
    """Table schemas by table name."""
    tables: dict[str, list[ColumnSpec]] = {}
    for row in catalog.orderBy("table_name", "ordinal").collect():
        spec = ColumnSpec(
            name=row.column_name.lower(),
            data_type=row.data_type.lower(),
            ordinal=row.ordinal,
            precision=row.precision,
            scale=row.scale,
            unsigned=bool(row.unsigned),
            nullable=row.nullable is not False,
            pk_pos=row.pk_pos,
            default=row.default_value,
        )
        tables.setdefault(row.table_name, []).append(spec)
    unreadable = [
        f"{name}.{c.name}" for name, columns in tables.items() for c in columns if c.pk_pos is None and (c.default or "").startswith(UNREADABLE)
    ]
    if unreadable:
        raise ValueError(f"give plain values for the defaults of {', '.join(unreadable)}")
    return {name: TableSchema(name, tuple(columns)) for name, columns in tables.items()}


def table_schema(catalog: DataFrame, table: str) -> TableSchema:
    """Schema of one table, named in any case; an unknown table is an error."""
    table = table.lower()
    found = compile_catalog(catalog.filter(F.col("table_name") == table))
    if table not in found:
        raise LookupError(f"table {table} not found in the catalog")
    return found[table]


def primary_keys(catalog: DataFrame, table: str) -> DataFrame:
    """Key columns of a table in key order."""
    mine = catalog.filter((F.col("table_name") == table.lower()) & F.col("pk_pos").isNotNull())
    return mine.orderBy("pk_pos").select("column_name", "pk_pos")


def column_info(catalog: DataFrame, table: str, column: str) -> DataFrame:
    """The catalog row of one column."""
    return catalog.filter((F.col("table_name") == table.lower()) & (F.col("column_name") == column.lower()))


def column_type(catalog: DataFrame, table: str, column: str) -> str | None:
    """Data type of one column, None if there is no such column."""
    row = column_info(catalog, table, column).select("data_type").first()
    return row.data_type if row else None


def is_primary_key(catalog: DataFrame, table: str, column: str) -> bool:
    """Whether a column belongs to the key of its table."""
    row = column_info(catalog, table, column).select("pk_pos").first()
    return row is not None and row.pk_pos is not None


# Catalog type names for the types a Spark source can have.
_CATALOG_TYPE_OF = {
    "boolean": "bit",
    "tinyint": "tinyint",
    "smallint": "smallint",
    "int": "int",
    "bigint": "bigint",
    "float": "float",
    "double": "double",
    "string": "varchar",
    "binary": "blob",
    "date": "date",
    "timestamp": "timestamp",
    "timestamp_ntz": "datetime",
}


def observed_columns(frame: DataFrame, table: str) -> DataFrame:
    """Catalog columns of a source table, with nullability read from its rows.

    One pass and one row of partial counts per task, however many columns there are.
    """
    counts = frame.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(frame.columns)]
    )
    cells = []
    for i, field in enumerate(frame.schema.fields):
        decimal = isinstance(field.dataType, T.DecimalType)
        simple = "decimal" if decimal else field.dataType.simpleString()
        cells.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(i + 1).alias("ordinal"),
                F.lit(_CATALOG_TYPE_OF.get(simple, "decimal" if decimal else "json")).alias("data_type"),
                F.lit(field.dataType.precision if decimal else None).cast("int").alias("precision"),
                F.lit(field.dataType.scale if decimal else None).cast("int").alias("scale"),
                F.lit(False).alias("unsigned"),
                (F.col(f"n{i}") < F.col("__rows")).alias("nullable"),
                F.lit(None).cast("string").alias("default_value"),
            )
        )
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*cells)))
