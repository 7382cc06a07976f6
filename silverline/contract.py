"""Record contracts, quality rules, repairs and the table layout, as plain data.

A :class:`Contract` says how one raw JSON line becomes a typed record: the
declared source schema (parsed with ``from_json``), which field is the key and
what type it gets, which fields are dates, which named rules a clean record
must pass and how a quarantined record may be repaired. The same functions
serve any contract; two are defined here: the movie documents the library was
written for and the order feed the tests derive from the TPC-H style tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate over typed columns; a record passes when it is TRUE."""

    name: str
    predicate: str


@dataclass(frozen=True)
class Contract:
    name: str
    source_ddl: str                      # declared spelling, used by from_json
    key_field: str                       # source field holding the identifier
    key_column: str                      # name of the typed identifier
    key_type: str                        # SQL type of the typed identifier
    date_fields: tuple[str, ...]         # source fields typed to DATE
    rules: tuple[Rule, ...]              # all must hold for a clean record
    partition_column: str                # silver partition column
    partition_expr: str | None = None    # SQL for a derived partition column (DATE)
    nested_field: str = "genres"         # JSON array kept as text
    nested_ddl: str = "ARRAY<STRUCT<id: BIGINT, name: STRING>>"
    repairs: dict[str, str] = field(default_factory=dict)   # column -> SQL expression
    language_fields: tuple[str, ...] = ("Title", "OriginalLanguage")

    @property
    def source_fields(self) -> list[str]:
        return StructType.fromDDL(self.source_ddl).fieldNames()

    def typed_fields(self) -> list[str]:
        """Typed column names in source order (the key renamed)."""
        return [self.key_column if f == self.key_field else f for f in self.source_fields]

    def silver_fields(self) -> list[str]:
        """Silver columns: typed fields, then a derived partition column if any."""
        return self.typed_fields() + ([self.partition_column] if self.partition_expr else [])

    def typed_ddl(self) -> str:
        parts = []
        for f in StructType.fromDDL(self.source_ddl).fields:
            if f.name == self.key_field:
                parts.append(f"{self.key_column} {self.key_type}")
            elif f.name in self.date_fields:
                parts.append(f"{f.name} DATE")
            else:
                parts.append(f"{f.name} {f.dataType.simpleString().upper()}")
        return ", ".join(parts)


# Fixed values of the movie documents: declared schema, key, date fields,
# the two quality rules and the floor used by the budget repair.
MOVIE_SOURCE_DDL = (
    "BackdropUrl STRING, Budget DOUBLE, CreatedBy STRING, CreatedDate STRING, Id STRING, "
    "ImdbUrl STRING, OriginalLanguage STRING, Overview STRING, PosterUrl STRING, Price STRING, "
    "ReleaseDate STRING, Revenue STRING, RunTime LONG, Tagline STRING, Title STRING, "
    "TmdbUrl STRING, UpdatedBy STRING, UpdatedDate STRING, genres STRING"
)
MOVIE_BUDGET_FLOOR = 1_000_000

MOVIE_CONTRACT = Contract(
    name="movie",
    source_ddl=MOVIE_SOURCE_DDL,
    key_field="Id",
    key_column="movie_id",
    key_type="INT",
    date_fields=("CreatedDate", "ReleaseDate", "UpdatedDate"),
    rules=(Rule("runtime_non_negative", "RunTime >= 0"),
           Rule("budget_floor", f"Budget >= {MOVIE_BUDGET_FLOOR}")),
    partition_column="CreatedDate",
    repairs={"RunTime": "abs(RunTime)",
             "Budget": f"greatest(coalesce(Budget, {MOVIE_BUDGET_FLOOR}D), {MOVIE_BUDGET_FLOOR}D)"},
)

# The order feed (see FIXTURES.md): an order stands for a movie. Its key is
# BIGINT because order keys outgrow INT at large scale factors; the budget
# floor is 100,000 because 1,000,000 exceeds every order total.
ORDER_FEED_DDL = ("Id STRING, Title STRING, Budget DOUBLE, RunTime LONG, "
                  "OriginalLanguage STRING, ReleaseDate STRING, genres STRING")
ORDER_BUDGET_FLOOR = 100_000

ORDER_CONTRACT = Contract(
    name="order_feed",
    source_ddl=ORDER_FEED_DDL,
    key_field="Id",
    key_column="movie_id",
    key_type="BIGINT",
    date_fields=("ReleaseDate",),
    rules=(Rule("runtime_non_negative", "RunTime >= 0"),
           Rule("budget_floor", f"Budget >= {ORDER_BUDGET_FLOOR}")),
    # Monthly partitions: about 85 folders over the feed's seven years, so a
    # partition stays large at any scale factor, and a filter on the month prunes.
    partition_column="p_release_month",
    partition_expr="trunc(ReleaseDate, 'MM')",
    repairs={"RunTime": "abs(RunTime)",
             "Budget": f"greatest(coalesce(Budget, {ORDER_BUDGET_FLOOR}D), {ORDER_BUDGET_FLOOR}D)"},
)


@dataclass(frozen=True)
class TablePaths:
    """Folder layout of one medallion deployment below ``root``."""

    root: str

    @property
    def landing(self) -> str: return f"{self.root}/landing"
    @property
    def raw(self) -> str: return f"{self.root}/raw"
    @property
    def bronze(self) -> str: return f"{self.root}/bronze"
    @property
    def silver(self) -> str: return f"{self.root}/silver/wide"
    @property
    def silver_movie(self) -> str: return f"{self.root}/silver/movie"
    @property
    def genre(self) -> str: return f"{self.root}/silver/genre"
    @property
    def genre_dim(self) -> str: return f"{self.root}/silver/genre_dim"
    @property
    def language(self) -> str: return f"{self.root}/silver/language"
    @property
    def bridge(self) -> str: return f"{self.root}/silver/bridge"
    @property
    def batches(self) -> str: return f"{self.root}/batches"
    @property
    def checkpoints(self) -> str: return f"{self.root}/_checkpoints"
    @property
    def arrivals(self) -> str: return f"{self.root}/arrivals"
