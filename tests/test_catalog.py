from fleetscope.operators import catalog
from tests.conftest import as_dicts

COLUMNS = (
    "schema_name string, table_name string, column_name string, ordinal bigint, data_type string, domain_name string, "
    "max_length int, is_nullable boolean, default_value string"
)
KEYS = (
    "schema_name string, table_name string, key_name string, kind string, is_clustered boolean, referenced_table string, "
    "column_name string, referenced_column string, key_ordinal int, is_descending boolean"
)


def profile(rows):
    return catalog.catalog_column_profile(
        rows(
            COLUMNS,
            ("dbo", "t", "id", 1, "int", None, None, False, None),
            ("dbo", "t", "name", 2, "varchar", None, 50, True, "('x')"),
            ("dbo", "t", "note", 3, "varchar", None, -1, True, None),
            ("dbo", "t", "code", 4, "varchar", "code_type", 9, False, None),
            ("dbo", "t", "gone", 5, "strange", None, None, False, None),
        ),
        rows("schema_name string, table_name string, column_name string, seed int, increment int", ("dbo", "t", "id", 1000, 1)),
        rows("type_name string, collation string", ("int", None), ("varchar", "CI"), ("code_type", "CI")),
        rows(
            "schema_name string, table_name string, column_name string, default_name string, object_type string",
            ("dbo", "t", "name", "df_name", "D"), ("dbo", "t", "note", "rule", "R"),
        ),
    )


def key_rows(rows):
    return rows(
        KEYS,
        ("dbo", "t", "pk_t", "PK", True, None, "name", None, 2, True),
        ("dbo", "t", "pk_t", "PK", True, None, "id", None, 1, False),
        ("dbo", "t", "uq_t", "UQ", False, None, "code", None, 1, False),
        ("dbo", "t", "fk_t", "FK", False, "parent", "code", "p_code", 1, False),
        ("dbo", "t", "ix_t", "IX", False, None, "note", None, 1, False),
    )


def test_profile_drops_unknown_types_and_keeps_real_defaults(spark, rows):
    got = as_dicts(profile(rows), "ordinal")
    assert [g["column_name"] for g in got] == ["id", "name", "note", "code"]
    assert [g["default_name"] for g in got] == [None, "df_name", None, None]
    assert got[0]["is_identity"] and got[0]["identity_seed"] == 1000 and not got[0]["is_char"]


def test_key_columns_follow_their_ordinal(spark, rows):
    got = {g["key_name"]: g for g in as_dicts(catalog.catalog_key_columns(key_rows(rows)))}
    assert got["pk_t"]["key_columns"] == "id ASC,name DESC"
    assert got["fk_t"]["referenced_columns"] == "p_code"


CHECKS = "schema_name string, table_name string, check_name string, definition string"
ORDER = ("schema_name", "table_name", "section", "position", "item")


def script(rows, **options):
    lines = catalog.catalog_table_script(
        profile(rows), catalog.catalog_key_columns(key_rows(rows)),
        rows(CHECKS, ("dbo", "t", "ck_t", "([id]>(0))")), **options,
    )
    return [line["line"] for line in as_dicts(lines, *ORDER)]


def test_script_of_a_table(spark, rows):
    assert script(rows) == [
        "CREATE TABLE dbo.t",
        "(",
        "[id] INT IDENTITY(1000,1) NOT NULL ,",
        "[name] VARCHAR(50) NULL CONSTRAINT [df_name] DEFAULT('X'),",
        "[note] VARCHAR(MAX) NULL ,",
        "[code] code_type NOT NULL ",
        ",CONSTRAINT [fk_t] FOREIGN KEY (code) REFERENCES [parent](p_code)",
        ",CONSTRAINT [ck_t] CHECK ([id]>(0))",
        ",CONSTRAINT pk_t PRIMARY KEY  CLUSTERED (id ASC,name DESC)",
        ",CONSTRAINT uq_t UNIQUE  NONCLUSTERED (code ASC)",
        ")",
        "CREATE NONCLUSTERED INDEX [ix_t] ON [t] (note ASC)",
    ]


def test_script_options(spark, rows):
    lines = script(rows, with_constraints=False, with_indexes=False, system_types=True)
    assert lines[3] == "[name] VARCHAR(50) NULL ,"
    assert lines[5] == "[code] VARCHAR(9) NOT NULL "
    assert lines[-1] == ")" and len(lines) == 7


def test_one_name_in_two_schemas_is_two_tables(spark, rows):
    both = rows("table_schema string", ("a",), ("b",)).withColumnRenamed("table_schema", "schema_name")
    twice = profile(rows).drop("schema_name").crossJoin(both)
    keys = catalog.catalog_key_columns(key_rows(rows)).limit(0)
    lines = catalog.catalog_table_script(twice, keys, rows(CHECKS), database="db")
    heads = [line["line"] for line in as_dicts(lines, *ORDER) if line["section"] == catalog.HEADER]
    assert heads == ["CREATE TABLE db.a.t", "CREATE TABLE db.b.t"]
    assert lines.count() == 2 * 7
    renamed = catalog.catalog_table_script(profile(rows), keys, rows(CHECKS), new_name="copy_of_t")
    assert as_dicts(renamed, *ORDER)[0]["line"] == "CREATE TABLE copy_of_t"
