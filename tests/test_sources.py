from pyspark.sql import functions as F

from fleetscope.operators import services
from fleetscope.sources import config_xml, fleet, listings, templates
from tests.conftest import as_dicts, plan_of

DOC = """<Root>
  <Instances><Primary Server="S" Instance="A"/>
    <More><Database Server="S" Instance="B"/></More>
    <More><Database Server="S" Instance="A"/><Database Server=" T " Instance=""/></More>
  </Instances>
  <Mail><Setting Name="port" Value="25"/><Setting Name="port" Value="99"/>
        <Setting Name="ssl" Value="yes"/></Mail>
</Root>"""


def docs(rows):
    return rows("doc_id int, xml string", (1, DOC), (2, "<Root/>"), (3, "broken <"))


def test_shred_covers_every_repeated_level(spark, rows):
    got = as_dicts(
        config_xml.shred_elements(docs(rows), "Instances/More/Database", ["Server", "Instance", "Port"])
    )
    assert [(g["doc_id"], g["Server"], g["Instance"], g["Port"]) for g in got] == [
        (1, "S", "B", None), (1, "S", "A", None), (1, " T ", "", None),
    ]


def test_settings_take_the_first_and_null_for_absent_or_bad(spark, rows):
    names = {"port": "int", "ssl": "int", "user": "string"}
    got = as_dicts(config_xml.pivot_settings(docs(rows), "Mail/Setting", names), "doc_id")
    assert got[0] == {"doc_id": 1, "port": 25, "ssl": None, "user": None}
    assert [g["port"] for g in got] == [25, None, None]


def test_topology_without_duplicates(spark, rows):
    got = config_xml.instance_topology(
        docs(rows), "Instances/Primary", "Instances/More/Database", ["Server", "Instance"]
    )
    assert sorted((r.Server, r.Instance) for r in got.collect()) == [(" T ", ""), ("S", "A"), ("S", "B")]


def test_topology_parses_once_and_does_not_shuffle(spark, rows):
    plan = plan_of(config_xml.instance_topology(
        docs(rows), "Instances/Primary", "Instances/More/Database", ["Server", "Instance"]
    ))
    assert "Exchange" not in plan and plan.count("from_xml(") == 1


def test_settings_do_not_shuffle(spark, rows):
    assert "Exchange" not in plan_of(config_xml.pivot_settings(docs(rows), "Mail/Setting", {"port": "int"}))


def test_elements_from_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text(DOC)
    got = config_xml.read_elements(spark, str(tmp_path / "a.xml"), "Database", ["Server", "Instance"])
    assert sorted((r.Server, r.Instance) for r in got.collect()) == [(" T ", ""), ("S", "A"), ("S", "B")]


def test_templates(spark, tmp_path):
    (tmp_path / "t.sql").write_bytes("\ufeffUSE [<db>]\nGO <file>\n".encode())
    frame = templates.read_templates(spark, str(tmp_path / "t.sql"))
    text = templates.render(F.col("template"), {"<file>": "<db>.xml", "<db>": "console"})
    assert frame.select(text.alias("t")).first()["t"] == "USE [console]\nGO console.xml\n"


LISTING = "\r\n".join(
    [
        "",
        "Name  Status DisplayName",
        "----  ------ -----------",
        "MSSQL$A    Stopped  SQL Server (MSSQL$A)",
        "sqlagent$a Running  Agent running (SQLAGENT$A) fine",
        "",
        "SQLWriter  Stopped  Writer",
        "MSSQL$B",
        "MSSQL$C Stopped",
        "SQLAGENT$D  stopped  Agent D",
    ]
)


def test_listing_levels_and_rejects(spark, rows):
    lines = listings.numbered_lines(rows("server string, output string", ("S", LISTING)))
    parsed = as_dicts(listings.parse_listing(lines), "row_id")
    assert [(p["name"], p["status"], p["service_name"]) for p in parsed] == [
        ("MSSQL$A", "Stopped", "SQL Server ()"),
        ("sqlagent$a", "Running", "Agent  () fine"),
        ("SQLWriter", "Stopped", "Writer"),
        ("SQLAGENT$D", "stopped", "Agent D"),
    ]
    rejects = as_dicts(listings.listing_rejects(lines), "row_id")
    assert [r["value"] for r in rejects] == ["MSSQL$B", "MSSQL$C Stopped"]
    stopped = services.stopped_services(listings.parse_listing(lines))
    assert sorted(s.name for s in stopped.collect()) == ["MSSQL$A", "SQLAGENT$D"]


def test_service_report_is_ordered_by_name(spark, rows):
    import datetime as dt

    ddl = "server string, row_id bigint, status string, name string, service_name string"
    stopped = rows(ddl, ("S", 4, "Stopped", "MSSQL$B", "b"), ("S", 5, "Stopped", "MSSQL$A", "<a>"), ("T", 4, "Paused", "MSSQL$C", "c"))
    pages = as_dicts(
        services.stopped_services_report(stopped, dt.datetime(2024, 1, 15), page_rows=1), "server", "page"
    )
    assert [(p["server"], p["page"]) for p in pages] == [("S", 1), ("S", 2), ("T", 1)]
    assert "<td>MSSQL$A</td><td>&lt;a&gt;</td>" in pages[0]["body"]


def test_fleet_frames_and_files(spark, rows, tmp_path):
    jobs = {"A": rows("jobs", (1, "x", 1)), "B": rows("jobs", (1, "y", 0), (2, "z", 1))}
    stacked = fleet.collect_fleet(jobs)
    assert sorted((r.server, r.job_id) for r in stacked.collect()) == [("A", 1), ("B", 1), ("B", 2)]
    stacked.write.partitionBy("server").parquet(str(tmp_path / "fleet"))
    read = fleet.read_fleet(spark, str(tmp_path / "fleet"), "job_id bigint, name string, enabled int, server string")
    assert read.count() == 3
    assert "PartitionFilters: [isnotnull(server" in plan_of(read.filter("server = 'B'"))
