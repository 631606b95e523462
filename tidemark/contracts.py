"""Record contracts: declared fields, endpoint and paging metadata.

A contract is the single description of one source table.  It yields the
Spark ``StructType`` used to parse raw records, the projection list (P1), the
name signature (F7), the default for list fields (F13) and a small registry
DataFrame that the planning joins (J1-J3) broadcast.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import literal_frame

# ---------------------------------------------------------------------------
# Fixed values that must equal the source system's declarations.
# Start watermark: 2020-01-01T00:00:00Z.  Page size 500, offset wrap 10000.
# The field lists are further down, in declaration order, which the signature
# depends on.
# ---------------------------------------------------------------------------
START_WATERMARK = 1577836800
PAGE_SIZE = 500
OFFSET_WRAP = 10000
LAYERS = ("RAW", "ANALYTICS")

_TYPES = {
    "bigint": T.LongType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    dtype: T.DataType
    required: bool = False
    alias: str | None = None

    @property
    def source_name(self) -> str:
        return self.alias or self.name

    @property
    def is_list(self) -> bool:
        return isinstance(self.dtype, T.ArrayType)


@dataclass(frozen=True)
class Contract:
    name: str
    endpoint: str
    fields: tuple[FieldSpec, ...]
    start: int = START_WATERMARK
    page_size: int = PAGE_SIZE
    key: str = "id"
    order: str = "updated_at"
    unique: tuple[str, ...] = ("id",)
    extras: dict = field(default_factory=dict, compare=False, hash=False)

    # -- schema -----------------------------------------------------------
    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def source_names(self) -> list[str]:
        return [f.source_name for f in self.fields]

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    def schema(self) -> T.StructType:
        """Parse schema: every field nullable so that a missing value is a
        quality finding (Q1/Q3) rather than a parse failure."""
        return T.StructType([T.StructField(f.source_name, f.dtype, True) for f in self.fields])

    # -- P1 / F13 --------------------------------------------------------
    def projection(self) -> list[Column]:
        """Declared fields under their declared names, list fields defaulted
        to an empty array (F13)."""
        cols = []
        for f in self.fields:
            c = F.col(f.source_name)
            if f.is_list:
                c = F.coalesce(c, F.array().cast(f.dtype))
            cols.append(c.alias(f.name))
        return cols

    def parsed(self) -> list[Column]:
        """The fields of a parsed record, which carry their declared names
        already, with F13's list default."""
        return [F.coalesce(F.col(f.name), F.array().cast(f.dtype)).alias(f.name) if f.is_list else F.col(f.name)
                for f in self.fields]

    # -- F7 ---------------------------------------------------------------
    def signature(self) -> str:
        """SHA-256 of the space-joined declared names (names only, order
        sensitive)."""
        return hashlib.sha256(" ".join(self.source_names).encode()).hexdigest()


LONG, TEXT, DOUBLE, LONGS = T.LongType(), T.StringType(), T.DoubleType(), T.ArrayType(T.LongType())

# The declared fields of the five source tables.
CONTRACTS: dict[str, Contract] = {
    "GameSchema": Contract(name="GameSchema", endpoint="/games", fields=(
        FieldSpec("id", LONG, required=True),
        FieldSpec("name", TEXT, required=True),
        FieldSpec("slug", TEXT),
        FieldSpec("summary", TEXT),
        FieldSpec("storyline", TEXT),
        FieldSpec("created_at", LONG),
        FieldSpec("updated_at", LONG),
        FieldSpec("first_release_date", LONG),
        FieldSpec("rating", DOUBLE),
        FieldSpec("rating_count", LONG),
        FieldSpec("aggregated_rating", DOUBLE),
        FieldSpec("aggregated_rating_count", LONG),
        FieldSpec("total_rating", DOUBLE),
        FieldSpec("total_rating_count", LONG),
        FieldSpec("hypes", LONG),
        FieldSpec("game_type", LONG),
        FieldSpec("game_status", LONG),
        FieldSpec("genres", LONGS),
        FieldSpec("platforms", LONGS),
        FieldSpec("involved_companies", LONGS),
        FieldSpec("release_dates", LONGS),
        FieldSpec("game_modes", LONGS),
        FieldSpec("themes", LONGS),
        FieldSpec("collections", LONGS),
        FieldSpec("parent_game", LONG),
        FieldSpec("version_parent", LONG),
        FieldSpec("version_title", TEXT),
        FieldSpec("checksum", TEXT),
    )),
    "ReleaseDateSchema": Contract(name="ReleaseDateSchema", endpoint="/release_dates", fields=(
        FieldSpec("id", LONG, required=True),
        FieldSpec("game", LONG),
        FieldSpec("platform", LONG),
        FieldSpec("date", LONG),
        FieldSpec("human", TEXT),
        FieldSpec("y", LONG),
        FieldSpec("m", LONG),
        FieldSpec("region", LONG),
        FieldSpec("status", LONG),
        FieldSpec("created_at", LONG),
        FieldSpec("updated_at", LONG),
        FieldSpec("checksum", TEXT),
    )),
    "GenreSchema": Contract(name="GenreSchema", endpoint="/genres", fields=(
        FieldSpec("id", LONG, required=True),
        FieldSpec("name", TEXT, required=True),
        FieldSpec("slug", TEXT),
        FieldSpec("created_at", LONG),
        FieldSpec("updated_at", LONG),
        FieldSpec("checksum", TEXT),
    )),
    "PlatformSchema": Contract(name="PlatformSchema", endpoint="/platforms", fields=(
        FieldSpec("id", LONG, required=True),
        FieldSpec("name", TEXT, required=True),
        FieldSpec("slug", TEXT),
        FieldSpec("abbreviation", TEXT),
        FieldSpec("alternative_name", TEXT),
        FieldSpec("generation", LONG),
        FieldSpec("platform_family", LONG),
        FieldSpec("created_at", LONG),
        FieldSpec("updated_at", LONG),
        FieldSpec("checksum", TEXT),
    )),
    "CompanySchema": Contract(name="CompanySchema", endpoint="/companies", fields=(
        FieldSpec("id", LONG, required=True),
        FieldSpec("name", TEXT, required=True),
        FieldSpec("slug", TEXT),
        FieldSpec("description", TEXT),
        FieldSpec("country", LONG),
        FieldSpec("parent", LONG),
        FieldSpec("changed_company_id", LONG),
        FieldSpec("created_at", LONG),
        FieldSpec("updated_at", LONG),
        FieldSpec("checksum", TEXT),
    )),
}


def contract(name: str) -> Contract:
    return CONTRACTS[name]


def registry_frame(spark: SparkSession, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """One row per contract: table_name, endpoint, start_watermark,
    page_size, schema_hash, declared_columns.  Bounded by the number of
    declared contracts, so it is always safe to broadcast."""
    contracts = contracts or CONTRACTS
    rows = [(c.name, c.endpoint, c.start, c.page_size, c.signature(), c.source_names,
             [f.source_name for f in c.fields if f.required])
            for c in contracts.values()]
    schema = ("table_name string, endpoint string, start_watermark bigint, page_size int, "
              "schema_hash string, declared_columns array<string>, required_columns array<string>")
    return literal_frame(spark, rows, schema)


_FAMILY = {"bigint": "integer", "double": "number", "string": "string", "array<bigint>": "array"}


def columns_frame(spark: SparkSession, contracts: dict[str, Contract] | None = None) -> DataFrame:
    """One row per declared column: table_name, column_name, position,
    data_type (Spark DDL), json_family, required.  Bounded by the contracts."""
    contracts = contracts or CONTRACTS
    rows = [(c.name, f.source_name, i, f.dtype.simpleString(), _FAMILY.get(f.dtype.simpleString(), "object"), f.required)
            for c in contracts.values() for i, f in enumerate(c.fields)]
    return literal_frame(spark, rows, "table_name string, column_name string, position int, data_type string, "
                                      "json_family string, required boolean")


def table_contract(name: str, fields: list[tuple[str, str, bool]], *, endpoint: str | None = None,
                   start: int = START_WATERMARK, page_size: int = PAGE_SIZE) -> Contract:
    """Declare a contract for a table that is not one of the five (tests and
    stand-in sources)."""
    specs = tuple(FieldSpec(n, _TYPES.get(t, T._parse_datatype_string(t)), r) for n, t, r in fields)
    return Contract(name=name, endpoint=endpoint or f"/{name}", fields=specs, start=start,
                    page_size=page_size)
