import datetime as dt
import re

from pyspark.sql import functions as F

from fleetscope.operators import incidents
from tests.conftest import as_dicts, plan_of

NOW = dt.datetime(2024, 1, 15, 13, 30)


def report(*sides):
    return f"<TextData><blocked-process-report>{''.join(sides)}</blocked-process-report></TextData>"


def process(text="", **attributes):
    listed = "".join(f' {k}="{v}"' for k, v in attributes.items())
    return f"<process{listed}>{text}</process>"


def blocked(*processes):
    return f"<blocked-process>{''.join(processes)}</blocked-process>"


def blocking(*processes):
    return f"<blocking-process>{''.join(processes)}</blocking-process>"


def test_session_is_the_first_that_is_given(spark, rows):
    document = report(blocked(process()), blocking(process(), process(spid="77"), process(spid="8")))
    reports = rows("blocked_reports", (1, NOW, document))
    stored = incidents.blocked_events_store(reports).first()
    assert stored["spid"] == 77 and stored["blocked_report"] == document


DATABASES = [(5, "sales", 1, False, False)]


def test_details_have_defaults_and_order(spark, rows):
    document = report(
        blocked(
            process("<inputbuf> select 1 &lt; 2 </inputbuf>", waittime="30", currentdb="5", status="x"),
            process(currentdb="77", lockMode="X"),
        ),
        blocking(process("<inputbuf>upd</inputbuf>", spid="9", waittime="1", currentdb="abc")),
    )
    got = as_dicts(
        incidents.blocked_process_details(
            rows("blocked_reports", (1, NOW, document)), rows("databases", *DATABASES)
        ),
        "position",
    )
    assert [(g["nature"], g["currentdb"]) for g in got] == [
        ("Blocked", "sales"), ("Blocked", ""), ("BlockedBy", ""),
    ]
    assert got[0]["inputbuf"] == " select 1 < 2 " and got[0]["waittime"] == "30"
    assert got[1]["lock_mode"] == "X" and got[1]["status"] == "" and got[1]["inputbuf"] == ""
    # the blocking side has no wait time even if the document gives one
    assert got[2]["waittime"] == "" and got[2]["inputbuf"] == "upd"


def test_stored_session_id_is_the_first_or_missing(spark, rows):
    reports = rows(
        "blocked_reports",
        (10, NOW, report(blocked(process()), blocking(process(spid="51"), process(spid="52")))),
        (20, NOW, report(blocked(process()))),
        (30, NOW, report(blocking(process(status="s")))),
        (40, NOW, "<TextData/>"),
        (50, NOW, "not xml"),
    )
    got = as_dicts(incidents.blocked_events_store(reports), "event_id")
    assert [g["spid"] for g in got] == [51, None, None, None, None]
    assert [g["blocked_events_id"] for g in got] == [1, 2, 3, 4, 5]
    assert got[4]["blocked_report"] == "not xml"


def test_rendered_report_escapes_everything(spark, rows):
    document = report(blocked(process("<inputbuf>a &lt; b</inputbuf>", currentdb="5")))
    reports = rows("blocked_reports", (1, NOW, document), (2, NOW, "<TextData/>"))
    got = as_dicts(incidents.blocked_report_render(reports, rows("databases", *DATABASES)), "event_id")
    assert "<td>sales</td><td>Blocked</td>" in got[0]["body"]
    assert "<td>a &lt; b</td>" in got[0]["body"]
    assert "&lt;TextData&gt;" in got[0]["body"] and "<TextData>" not in got[0]["body"]
    assert "<td>&lt;TextData/&gt;</td>" in got[1]["body"]


def test_details_need_no_python_and_no_nested_loop(spark, rows):
    plan = plan_of(
        incidents.blocked_process_details(
            rows("blocked_reports", (1, NOW, "<a/>")), rows("databases", *DATABASES)
        )
    )
    assert "NestedLoop" not in plan and "Python" not in plan


def test_one_database_in_most_reports(spark, rows):
    reports = spark.range(3000).select(
        F.col("id").alias("event_id"),
        F.lit(NOW).cast("timestamp_ntz").alias("alert"),
        F.concat(
            F.lit('<TextData><blocked-process-report><blocked-process><process currentdb="'),
            F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5).cast("string"),
            F.lit('"/></blocked-process></blocked-process-report></TextData>'),
        ).alias("report"),
        F.lit("S").alias("server"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = incidents.blocked_process_details(reports, rows("databases", *DATABASES))
        assert got.count() == 3000
        assert got.filter("currentdb = 'sales'").count() == 2000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_graph_text(spark, rows):
    graphs = rows("deadlock_docs", (7, "<a>&#x0A;b&#x20;c</a>"), (9, ""))
    got = as_dicts(incidents.deadlock_text_normalise(graphs), "doc_id")
    assert got[0]["body"] == incidents.GRAPH_LEAD + "<a>bc</a>"
    stored = as_dicts(incidents.deadlock_events_store(graphs, NOW), "doc_id")
    assert [(s["deadlock_events_id"], s["deadlock_graph"]) for s in stored] == [
        (1, "<a>&#x0A;b&#x20;c</a>"), (2, ""),
    ]


def test_database_ids_belong_to_their_server(spark, rows):
    databases = rows("databases", (5, "Sales", 1, False, False, "A"), (5, "HR", 1, False, False, "B"))
    document = report(blocked(process(currentdb="5")))
    reports = rows("blocked_reports", (1, NOW, document, "B"), (2, NOW, document, "C"))
    got = as_dicts(incidents.blocked_process_details(reports, databases), "event_id")
    assert [(g["event_id"], g["currentdb"]) for g in got] == [(1, "HR"), (2, "")]


def in_both_ways(reports, databases):
    """Details with dictionaries, and with ids and names shuffled."""
    out = []
    for most in (1000, 0):
        named = incidents.process_rows(incidents.database_name_lookup(reports, databases, max_names=most))
        out.append(sorted(map(tuple, named.select("event_id", "position", "database_id", "currentdb").collect()), key=str))
    assert out[0] == out[1]
    return out[0]


def test_names_of_a_server_with_many_databases(spark, rows):
    """Ids over many parts of the dictionary, an id twice, a missing id and name, reports without processes."""
    many = [(i, f"db{i}", 1, False, False, "A") for i in range(-3, 900, 3)]
    databases = rows("databases", *many, (3, "db30", 1, False, False, "A"), (None, "none", 1, False, False, "A"),
                     (6, None, 1, False, False, "B"))
    document = report(blocked(*[process(currentdb=str(i)) for i in (897, 898, 3, -3)], process()), blocking(process(currentdb="6")))
    reports = rows("blocked_reports", (1, NOW, document, "A"), (2, NOW, document, "B"), (3, NOW, "<a/>", "A"), (4, NOW, None, "C"))
    got = in_both_ways(reports, databases)
    assert [name for event, _, _, name in got if event == 1] == ["db897", "", "db30", "db-3", "", "db6"]
    assert {name for event, _, _, name in got if event == 2} == {""}
    assert {event for event, *_ in got} == {1, 2}


def test_render_reads_once_and_shuffles_no_text(spark, rows, tmp_path):
    reports = rows("blocked_reports", *[(i, NOW, report(blocked(process(currentdb="5")))) for i in range(9)])
    reports.write.parquet(f"{tmp_path}/reports")
    rendered = incidents.blocked_report_render(spark.read.parquet(f"{tmp_path}/reports"), rows("databases", *DATABASES))
    assert rendered.filter("body LIKE '%<td>sales</td>%'").count() == 9
    plan = plan_of(rendered)
    assert plan.count("Scan parquet") == 1 and "Generate" not in plan and "from_xml" in plan
    # The dictionaries are grouped by server; reports are not exchanged.
    exchanges = re.findall(r"(?<!Broadcast)(?<!Reused)Exchange \w+\(?\w*", plan)
    assert set(exchanges) == {"Exchange hashpartitioning(server"}


def test_storing_shuffles_no_text(spark, rows):
    texts = [(i, NOW, report(blocking(process(spid=str(i))))) for i in range(50, 0, -1)]
    stored = incidents.blocked_events_store(rows("blocked_reports", *texts).repartition(4), first=7)
    got = as_dicts(stored, "event_id")
    assert [(g["blocked_events_id"], g["spid"]) for g in got] == [(i + 6, i) for i in range(1, 51)]
    graphs = incidents.deadlock_events_store(rows("deadlock_docs", (7, "<a/>"), (9, "")), NOW)
    for frame in (stored, graphs):
        plan = plan_of(frame)
        exchanges = re.findall(r"(?<!Broadcast)(?<!Reused)Exchange \w+\(?\w*", plan)
        assert set(exchanges) == {"Exchange hashpartitioning(_file"}  # the runs of each file
        assert "Window" not in plan


def parses_of(df):
    return plan_of(df).count("from_xml(")


def test_exploded_processes_are_parsed_once(spark, rows, tmp_path):
    document = report(blocked(process(currentdb="5"), process()))
    rows("blocked_reports", (1, NOW, document), (2, NOW, "<a/>"), (3, NOW, None)).write.parquet(f"{tmp_path}/reports")
    reports = spark.read.parquet(f"{tmp_path}/reports")
    exploded = incidents.process_rows(reports)
    assert parses_of(exploded) == 1
    assert [(g["event_id"], g["position"]) for g in as_dicts(exploded, "position")] == [(1, 0), (1, 1)]
    assert parses_of(incidents.blocked_process_details(reports, rows("databases", *DATABASES))) == 1


def test_many_names_parse_once_and_keep_repeated_and_missing_events(spark, rows, tmp_path):
    """Beyond the broadcast, events that come twice, on two servers or without an id keep their names."""
    databases = rows("databases", (5, "Sales", 1, False, False, "A"), (5, "HR", 1, False, False, "B"), (6, "Six", 1, False, False, "A"))
    one, two = report(blocked(process(currentdb="5"))), report(blocked(process(currentdb="6"), process(currentdb="5"), process()))
    given = [(1, NOW, one, "A"), (1, NOW, one, "A"), (1, NOW, two, "A"), (1, NOW, one, "B"), (None, NOW, two, "A"), (None, NOW, one, "B"),
             (7, NOW, one, None), (8, NOW, "<a/>", "A")]
    rows("blocked_reports", *given).write.parquet(f"{tmp_path}/reports")
    reports = spark.read.parquet(f"{tmp_path}/reports")
    got = in_both_ways(reports, databases)
    assert sorted((event or 0, name) for event, _, _, name in got) == sorted(
        [(1, "Sales")] * 3 + [(1, "Six"), (1, ""), (1, "HR"), (0, "Six"), (0, "Sales"), (0, ""), (0, "HR"), (7, "")]
    )
    many = incidents.database_name_lookup(reports, databases, max_names=0)
    assert set(many.columns) == set(incidents.database_name_lookup(reports, databases).columns)
    assert many.count() == len(given) and parses_of(many) == 0  # parsed when it was written out
