"""Catalog snapshots: column profiles, key columns, table scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.markup import bracketed
from fleetscope.operators.spread import spread_lookup

# Order of the parts of a table script.
HEADER, OPENING, COLUMNS, FOREIGN_KEYS, CHECKS, KEYS, CLOSING, INDEXES = range(1, 9)

TABLE = ["schema_name", "table_name"]


def catalog_column_profile(
    columns: DataFrame, identity: DataFrame, types: DataFrame, defaults: DataFrame
) -> DataFrame:
    """Columns with their identity, type and default facts.

    The type is found by the domain if there is one, else by the data type; a
    column of an unknown type drops out. Only default objects count as defaults.
    """
    key = [*TABLE, "column_name"]
    named = defaults.filter(F.col("object_type") == "D").select(*key, "default_name")
    return (
        columns.withColumn("type_name", F.coalesce("domain_name", "data_type"))
        .join(types.select("type_name", "collation"), "type_name")
        .join(identity.select(*key, "seed", "increment"), key, "left")
        .join(named, key, "left")
        .select(
            *columns.columns,
            "default_name",
            F.col("seed").isNotNull().alias("is_identity"),
            F.coalesce("seed", F.lit(0)).alias("identity_seed"),
            F.coalesce("increment", F.lit(0)).alias("identity_increment"),
            F.col("collation").isNotNull().alias("is_char"),
        )
    )


def catalog_key_columns(keys: DataFrame) -> DataFrame:
    """One row per key or index: its columns in key order as one text.

    The rows gathered per key are its columns, of which a host allows 32.
    """
    direction = F.when(F.col("is_descending"), " DESC").otherwise(" ASC")
    part = F.struct(
        "key_ordinal",
        "column_name",
        F.concat("column_name", direction).alias("ordered"),
        "referenced_column",
    )

    def joined(field: str) -> Column:
        return F.array_join(F.transform("parts", lambda p: p[field]), ",")

    return (
        keys.groupBy(*TABLE, "key_name", "kind", "is_clustered", "referenced_table")
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
        .select(
            *TABLE,
            "key_name",
            "kind",
            "is_clustered",
            "referenced_table",
            F.size("parts").cast("long").alias("n_columns"),
            joined("ordered").alias("key_columns"),
            joined("column_name").alias("plain_columns"),
            joined("referenced_column").alias("referenced_columns"),
        )
    )


def _column_definition(system_types: bool, with_constraints: bool) -> Column:
    nullable = F.when(F.col("is_nullable"), " NULL ").otherwise(" NOT NULL ")
    length = F.when(F.col("max_length") == -1, "MAX").otherwise(
        F.col("max_length").cast("string")
    )
    base = F.concat(
        F.upper("data_type"),
        F.when(F.col("is_char"), F.concat(F.lit("("), length, F.lit(")"))).otherwise(""),
        F.when(
            F.col("is_identity"),
            F.concat(
                F.lit(" IDENTITY("),
                F.col("identity_seed").cast("string"),
                F.lit(","),
                F.col("identity_increment").cast("string"),
                F.lit(")"),
            ),
        ).otherwise(""),
        nullable,
        F.when(
            F.col("default_name").isNotNull() & F.lit(with_constraints),
            F.concat(
                F.lit("CONSTRAINT "),
                bracketed(F.col("default_name")),
                F.lit(" DEFAULT"),
                F.coalesce(F.upper("default_value"), F.lit("")),
            ),
        ).otherwise(""),
    )
    by_domain = F.col("domain_name").isNotNull() & F.lit(not system_types)
    return F.concat(
        bracketed(F.col("column_name")),
        F.lit(" "),
        F.when(by_domain, F.concat(F.col("domain_name"), nullable)).otherwise(base),
    )


def _key_definition() -> Column:
    """The line of a foreign key, an index, or a primary or unique key."""
    kind, clustered = F.col("kind"), F.col("is_clustered")
    name = bracketed(F.col("key_name"))
    foreign = F.concat(
        F.lit(",CONSTRAINT "), name, F.lit(" FOREIGN KEY ("), F.col("plain_columns"),
        F.lit(") REFERENCES "), bracketed(F.col("referenced_table")),
        F.lit("("), F.col("referenced_columns"), F.lit(")"),
    )
    index = F.concat(
        F.lit("CREATE "), F.when(clustered, "CLUSTERED").otherwise("NONCLUSTERED"),
        F.lit(" INDEX "), name, F.lit(" ON "), bracketed(F.col("table_name")),
        F.lit(" ("), F.col("key_columns"), F.lit(")"),
    )
    words = (
        F.when((kind == "PK") & clustered, " PRIMARY KEY  CLUSTERED ")
        .when(kind == "PK", " PRIMARY KEY  NONCLUSTERED ")
        .when(clustered, " UNIQUE ")
        .otherwise(" UNIQUE  NONCLUSTERED ")
    )
    constraint = F.concat(
        F.lit(",CONSTRAINT "), "key_name", words, F.lit("("), "key_columns", F.lit(")")
    )
    return F.when(kind == "FK", foreign).when(kind == "IX", index).otherwise(constraint)


def catalog_table_script(
    profile: DataFrame,
    key_columns: DataFrame,
    checks: DataFrame,
    with_constraints: bool = True,
    with_indexes: bool = True,
    system_types: bool = False,
    database: str | None = None,
    new_name: str | None = None,
) -> DataFrame:
    """The script of every table, one row per line.

    The header names ``database`` (if given), schema and table, or ``new_name``.

    Sorted by table, section, position and item the lines read as the script.
    Lines stay rows, so a table of any width is spread over tasks.
    """
    no_position = F.lit(0).cast("long")
    title = F.concat_ws(".", F.lit(database), *TABLE) if new_name is None else F.lit(new_name)

    def lines(df: DataFrame, section: Column, position: Column, item: Column, line: Column):
        return df.select(
            *TABLE,
            section.alias("section"),
            position.cast("long").alias("position"),
            item.alias("item"),
            line.alias("line"),
        )

    tables = profile.groupBy(*TABLE).agg(F.max("ordinal").alias("last_ordinal"))
    framed = F.explode(
        F.array(
            F.struct(
                F.lit(HEADER).alias("section"),
                F.concat(F.lit("CREATE TABLE "), title).alias("line"),
            ),
            F.struct(F.lit(OPENING).alias("section"), F.lit("(").alias("line")),
            F.struct(F.lit(CLOSING).alias("section"), F.lit(")").alias("line")),
        )
    )
    script = tables.select(*TABLE, framed.alias("frame")).select(
        *TABLE,
        F.col("frame.section").alias("section"),
        no_position.alias("position"),
        F.lit("").alias("item"),
        F.col("frame.line").alias("line"),
    )

    definition = F.concat(
        _column_definition(system_types, with_constraints),
        F.when(F.col("ordinal") == F.col("last_ordinal"), "").otherwise(","),
    )
    script = script.unionByName(
        lines(
            spread_lookup(profile, tables, TABLE, "ordinal"),
            F.lit(COLUMNS),
            F.col("ordinal"),
            F.col("column_name"),
            definition,
        )
    )

    if with_constraints:
        check = F.concat(
            F.lit(",CONSTRAINT "), bracketed(F.col("check_name")), F.lit(" CHECK "), "definition"
        )
        script = script.unionByName(
            lines(checks, F.lit(CHECKS), no_position, F.col("check_name"), check)
        )
    wanted = (["FK", "PK", "UQ"] if with_constraints else []) + (["IX"] if with_indexes else [])
    if wanted:
        kind = F.col("kind")
        section = F.when(kind == "FK", FOREIGN_KEYS).when(kind == "IX", INDEXES).otherwise(KEYS)
        script = script.unionByName(
            lines(
                key_columns.filter(kind.isin(*wanted)),
                section, no_position, F.col("key_name"), _key_definition(),
            )
        )
    return script
