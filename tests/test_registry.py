import datetime as dt
from decimal import Decimal

from fleetscope.operators import audits, registry
from fleetscope.schemas import OPEN_END
from tests.conftest import as_dicts

NOW = dt.datetime(2024, 1, 15, 13, 30)
OLD = dt.datetime(2023, 1, 1)
TODAY = dt.date(2023, 1, 1)


def instance(server, name, primary=False, monitored=True, installed=OPEN_END):
    return (f"{server}-{name}", server, name, "F:\\", primary, monitored, installed, TODAY)


def test_monitored_and_pending(spark, rows):
    table = rows(
        "instances",
        instance("A", "X"),
        instance("A", "P", primary=True),
        instance("A", "D", installed=OLD),
        instance("A", "N", monitored=False),
    )
    monitored = registry.instance_monitored(table)
    assert sorted(r.sql_instance for r in monitored.collect()) == ["A\\D", "A\\P", "A\\X"]
    assert [r.sql_instance for r in registry.instance_pending_install(table).collect()] == ["A\\X"]


OFFER = "server_name string, instance_name string, backup_location string"


def test_register_normalises_before_it_looks_up(spark, rows):
    table = rows("instances", instance("A", "X"))
    offered = rows(OFFER, (" a ", "x ", "G:\\"), ("b", " y", "H:\\"), ("B", "Y", "I:\\"))
    once = registry.instance_register(table, offered, NOW)
    got = as_dicts(once, "server_name")
    assert [(g["server_name"], g["instance_name"]) for g in got] == [("A", "X"), ("B", "Y")]
    assert got[1]["installed"] == OPEN_END and got[1]["is_monitored"]
    assert not got[1]["primary_console"] and got[1]["backup_location"] == "H:\\"
    twice = registry.instance_register(once, offered, NOW)
    assert as_dicts(twice, "server_name") == got
    assert audits.key_constraint_audit(twice, ["server_name", "instance_name"]).isEmpty()


def test_stored_names_match_in_any_case_and_keep_their_spelling(spark, rows):
    table = rows("instances", instance("srv1", "inst1"), instance("Srv1", " Inst2"))
    offered = rows(OFFER, ("SRV1", "INST1", "G:\\"), (" srv1", "inst2 ", "H:\\"), ("SRV1", "inst3", None))
    got = as_dicts(registry.instance_register(table, offered, NOW), "instance_name")
    assert [(g["server_name"], g["instance_name"]) for g in got] == [("Srv1", " Inst2"), ("SRV1", "INST3"), ("srv1", "inst1")]
    flagged = registry.instance_primary_flag(table, "SRV1\\INST1", NOW)
    assert [r.instance_name for r in flagged.filter("primary_console").collect()] == ["inst1"]


def test_primary_flag(spark, rows):
    table = rows("instances", instance("A", "X"), instance("A", "Y"))
    got = as_dicts(registry.instance_primary_flag(table, "A\\Y", NOW), "instance_name")
    assert [(g["primary_console"], g["installed"]) for g in got] == [(False, OPEN_END), (True, NOW)]


def release(number, script, error=False, message=None):
    return (number, Decimal("1.0"), script, "me", "o", "d", "New", error, message, TODAY, OLD, OLD)


RUN = (
    "seq bigint, version_number decimal(3,1), script_name string, author string, "
    "object_name string, description string, option string, is_error boolean, "
    "error_message string, release_date date"
)


def run(seq, script, version=Decimal("2.0"), error=False, message="", option="Alter"):
    return (seq, version, script, "you", "o2", "d2", option, error, message, TODAY)


def test_pending_releases(spark, rows):
    table = rows("releases", release(1, "ok"), release(2, "bad", error=True))
    offered = rows("list_id int, script_name string", (1, "ok"), (2, "bad"), (3, "new"))
    assert sorted(r.script_name for r in registry.release_pending(offered, table).collect()) == ["bad", "new"]


def test_upsert_rules(spark, rows):
    table = rows("releases", release(1005, "a", True, "x"), release(1009, "b"))
    source = rows(
        RUN,
        run(5, "a", version=None, message="p|q"),
        run(9, "d"),
        run(7, "c", option="New", message=""),
        run(8, "c", option="Last", message="  "),
    )
    once = registry.release_upsert(table, source, NOW)
    got = {g["script_name"]: g for g in as_dicts(once)}
    assert got["a"]["release_id"] == 1005 and got["a"]["version_number"] == Decimal("1.0")
    assert got["a"]["error_message"] == "p q" and not got["a"]["is_error"]
    assert got["a"]["installed"] == OLD and got["a"]["updated"] == NOW
    assert got["b"]["author"] == "me" and got["b"]["updated"] == OLD
    assert (got["c"]["release_id"], got["d"]["release_id"]) == (1010, 1011)
    assert got["c"]["option"] == "Last" and got["c"]["error_message"] is None
    assert got["c"]["installed"] == NOW
    twice = registry.release_upsert(once, source, NOW)
    assert {g["script_name"]: g for g in as_dicts(twice)} == got


def test_script_names_are_compared_without_case(spark, rows):
    table = rows("releases", release(1005, "a.SQL"))
    after = as_dicts(registry.release_upsert(table, rows(RUN, run(1, "A.sql"), run(2, "A.SQL")), NOW))
    assert [(r["release_id"], r["script_name"], r["author"]) for r in after] == [(1005, "a.SQL", "you")]
    offered = rows("list_id int, script_name string", (1, "A.sql"), (2, "b.sql"))
    assert [r.list_id for r in registry.release_pending(offered, table).collect()] == [2]


def test_first_release_id(spark, rows):
    got = registry.release_upsert(rows("releases"), rows(RUN, run(1, "a")), NOW)
    assert got.first()["release_id"] == 1000


def test_recipients(spark, rows):
    emails = rows(
        "alert_emails", (2, "b", "B@Example.com", True), (1, "a", "A@Example.com", True), (3, "c", "C@x", False)
    )
    assert registry.recipients_concat(emails, page_rows=10).first()["recipients"] == "a@example.com; b@example.com"
    lines = as_dicts(registry.recipients_concat(emails), "position")
    assert [r["recipient"] for r in lines] == ["a@example.com", "b@example.com"]
    pages = as_dicts(registry.recipients_concat(emails, page_rows=1), "page")
    assert [p["recipients"] for p in pages] == ["a@example.com", "b@example.com"]
    nobody = registry.recipients_concat(emails.filter("email_id = 3"), page_rows=1)
    assert [r.recipients for r in nobody.collect()] == [None]


def test_profiles_with_a_linked_account(spark, rows):
    profiles = rows("profile_id int, profile_name string", (1, "a"), (2, "b"), (3, "c"))
    links = rows("profile_id int, account_id int", (1, 10), (1, 10), (1, 11), (2, 99))
    accounts = rows("account_id int, account_name string", (10, "x"), (11, "y"))
    kept = registry.existence_semi_join(profiles, links, accounts)
    assert [r.profile_name for r in kept.collect()] == ["a"]


def test_audits(spark, rows):
    table = rows("a string, b string", ("x", "1"), ("x", "1"), ("y", None), ("z", "1"))
    found = as_dicts(audits.key_constraint_audit(table, ["a", "b"]), "a")
    assert [(f["a"], f["n_rows"], f["problem"]) for f in found] == [("x", 2, "duplicate"), ("y", 1, "missing")]
    indexes = rows(
        "schema_name string, table_name string, index_name string, data_space_id int",
        ("C", "t", "good", 1), ("C", "t", "bad", 2), ("C", "t", "lost", 9), ("R", "t", "other", 2),
    )
    spaces = rows("data_space_id int, data_space string", (1, "Configure"), (2, "PRIMARY"))
    wrong = audits.placement_violations(indexes, spaces, "C", "Configure")
    assert sorted(r.index_name for r in wrong.collect()) == ["bad", "lost"]
