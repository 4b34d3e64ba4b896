"""Source column types and the Spark type each one becomes in a replica."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Type families of the source and target databases.
DATETIME_TYPES = ("datetime", "timestamp", "timestamp with time zone", "timestamp without time zone", "timestamptz")
DATE_TYPES = ("date",)
TIME_TYPES = ("time", "time with time zone", "time without time zone", "timetz")
SMALL_TYPES = ("tinyint", "smallint")
INTEGER_TYPES = ("mediumint", "int", "integer")
BIGINT_TYPES = ("bigint",)
WHOLE_TYPES = (*SMALL_TYPES, *INTEGER_TYPES, *BIGINT_TYPES)
DECIMAL_TYPES = ("decimal", "numeric")
FLOAT_TYPES = ("float", "real")
DOUBLE_TYPES = ("double", "double precision")
BINARY_TYPES = ("tinyblob", "blob", "mediumblob", "longblob", "binary", "varbinary", "bytea")
BOOLEAN_TYPES = ("bit", "bool", "boolean")

# Families whose values are converted by a rule of their own; all others are cast to their Spark type.
FAMILIES = (DATETIME_TYPES, DATE_TYPES, TIME_TYPES, BOOLEAN_TYPES, BINARY_TYPES)

# What a bare DECIMAL means in the source database.
_DEFAULT_PRECISION, _DEFAULT_SCALE = 10, 0
_MAX_PRECISION = 38

DELETED_AT = "deleted_at"


@dataclass(frozen=True)
class ColumnSpec:
    """One catalog row. ``pk_pos`` counts from 1 and is None outside the key."""

    name: str
    data_type: str
    ordinal: int = 0
    precision: int | None = None
    scale: int | None = None
    unsigned: bool = False
    nullable: bool = True
    pk_pos: int | None = None
    default: str | None = None


@dataclass(frozen=True)
class TableSchema:
    """The columns of one table in ordinal order. Names are lower case."""

    table: str
    columns: tuple[ColumnSpec, ...]

    @property
    def keys(self) -> list[str]:
        in_key = [c for c in self.columns if c.pk_pos is not None]
        return [c.name for c in sorted(in_key, key=lambda c: c.pk_pos)]

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def values(self) -> list[ColumnSpec]:
        """Columns outside the key."""
        return [c for c in self.columns if c.pk_pos is None]

    def with_keys(self, keys: list[str]) -> TableSchema:
        """The same table with the caller's key columns, for tables that declare none."""
        wanted = [k.lower() for k in keys]
        missing = set(wanted) - set(self.names)
        if missing:
            raise KeyError(f"no such columns in {self.table}: {sorted(missing)}")
        columns = tuple(
            ColumnSpec(**{**c.__dict__, "pk_pos": wanted.index(c.name) + 1 if c.name in wanted else None})
            for c in self.columns
        )
        return TableSchema(self.table, columns)


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def spark_type(column: ColumnSpec, dialect: str = "postgres") -> T.DataType:
    """Spark type of a replica column.

    The ``mysql`` dialect keeps date-and-time columns as text in the target zone.
    Times stay text, because values beyond 24 hours are legal.
    """
    name = column.data_type
    if name in DATETIME_TYPES:
        return T.StringType() if dialect == "mysql" else T.TimestampType()
    if name in DATE_TYPES:
        return T.DateType()
    if name in SMALL_TYPES:
        return T.IntegerType() if column.unsigned and name == "smallint" else T.ShortType()
    if name in INTEGER_TYPES:
        return T.LongType() if column.unsigned else T.IntegerType()
    if name in BIGINT_TYPES:
        return T.DecimalType(20, 0) if column.unsigned else T.LongType()
    if name in DECIMAL_TYPES:
        if column.precision is None:
            return T.DecimalType(_DEFAULT_PRECISION, _DEFAULT_SCALE)
        if column.precision > _MAX_PRECISION:
            return T.StringType()
        return T.DecimalType(column.precision, column.scale or 0)
    if name in FLOAT_TYPES:
        return T.FloatType()
    if name in DOUBLE_TYPES:
        return T.DoubleType()
    if name in BINARY_TYPES:
        return T.BinaryType()
    if name in BOOLEAN_TYPES:
        return T.BooleanType()
    return T.StringType()


def replica_schema(table: TableSchema, dialect: str = "postgres") -> T.StructType:
    """Columns of the replica: the source's own plus the delete stamp."""
    fields = [T.StructField(c.name, spark_type(c, dialect)) for c in table.columns if c.name != DELETED_AT]
    return T.StructType(fields + [T.StructField(DELETED_AT, T.TimestampType())])
