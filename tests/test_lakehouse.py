"""Export files of all kinds through load, models, history, publishing and the public copy."""

from __future__ import annotations

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import contracts
from tidemark.plans import exports, history, insights
from tidemark.plans.bronze import EXPORT_TABLES, load_all, load_table
from tidemark.plans.enriched import Settings
from tidemark.plans.models import HISTORY_SOURCES, MART_NAMES, build_history, build_marts
from tidemark.plans.public_copy import build_public_copy
from tidemark.sources.export_dirs import resolve_export_dir
from tidemark.sources.inventory import build_inventory
from tidemark.sources.warehouse import Warehouse

FILES = {
    "connections": [
        ["First Name", "Last Name", "URL", "Email Address", "Company", "Position", "Connected On"],
        ["Ana", "Silva", "https://example.com/in/ana", "ana@x.io", "ACME", "Data Analyst", "01 Mar 2024"],
        ["Rui", "Reis", "https://example.com/in/rui", "", "Acme ", "Engineer", "15 Mar 2024"],
        ["Eva", "Luz", "https://example.com/in/eva", "", "Umbra", "Engineer", "02 Apr 2024"],
        ["Leo", "", "https://example.com/in/leo", "", "", "", "never"],
    ],
    "positions": [
        ["Company Name", "Title", "Description", "Location", "Started On", "Finished On"],
        ["ACME", "Analista de Dados", "x", "SP", "Jan 2020", "Mar 2022"],
        ["Umbra", "Engenheiro de Dados", "", "", "Mar 2022", ""],
    ],
    "profile": [
        ["First Name", "Last Name", "Headline", "Summary", "Industry", "Websites", "Birth Date"],
        ["Ana", "Silva", "Analista de BI", "short", "Tech", "[PERSONAL:https://wa.me/55]", "Jan 5, 1990"],
    ],
    "languages": [["Name", "Proficiency"], ["English", "Full professional"], ["Italiano", "Elementary"]],
    "education": [["School", "Degree", "Started", "Finished"], ["UFSC", "Bacharelado", "2016", "2019"], ["USP", "MBA", "2023", ""]],
    "certifications": [["Name", "Authority", "Started On", "Finished On"], ["AZ-900", "Microsoft", "May 2023", ""]],
    "endorsement_received_info": [
        ["Endorsement Date", "Skill Name", "Endorser First Name", "Endorser Last Name", "Endorsement Status"],
        ["2024-03-04", "SQL", "Rui", "Reis", "ACCEPTED"],
        ["2024-03-04", "SQL", "Rui", "Reis", "ACCEPTED"],
        ["2024-04-04", "SQL", "Eva", "", "PENDING"],
    ],
    "company_follows": [["Organization", "Followed On"], ["ACME", "2024-01-02"], ["ACME", "2024-01-02"], ["", "2024-01-03"]],
    "recommendations_received": [
        ["First Name", "Last Name", "Company", "Job Title", "Text", "Creation Date", "Status"],
        ["Eva", "Luz", "Umbra", "Lead", "Great data work\nwith the team", "04/05/24, 09:15 AM", "VISIBLE"],
    ],
    "skills": [["Name"], ["SQL"], ["Python"], ["SQL"], [" "]],
    "phone_numbers": [["Extension", "Number", "Type"], ["", "+551", "Mobile"]],
    "email_addresses": [["Email Address", "Confirmed", "Primary", "Updated On"], ["ana@x.io", "Yes", "Yes", "Not Available"]],
    "registration": [["Registered At", "Registration Ip", "Subscription Types"], ["03/01/15, 08:00 PM", "10.0.0.1", ""]],
    "saved_job_alerts": [
        ["Alert Parameters", "Query Context", "Saved Search ID"],
        ["frequency=DAILY", "keywords=data engineer,workplaceType:2", "1"],
    ],
    "volunteering": [["Company Name", "Role", "Cause", "Started On", "Finished On"], ["NGO", "Mentor", "", "2022", ""]],
    "invitations": [["From", "To", "Sent At", "Message", "Direction"], ["Ana", "Rui", "03/02/24, 10:00 AM", "Hi", "OUTGOING"]],
    "events": [
        ["Event Name", "Event Time", "Status", "External Url"],
        ["Talk", "Apr 10, 2024 08:00 AM - Apr 10, 2024 05:00 PM", "attending", "https://example.com/e"],
    ],
    "learning": [
        ["Content Title", "Content Type", "Content Last Watched Date (if viewed)", "Content Completed At (if completed)", "Content Saved"],
        ["Spark", "COURSE", "2024-02-01 10:00 UTC", "2024-02-03 10:00 UTC", "true"],
        ["SQL", "COURSE", "2024-02-02 10:00 UTC", "", "false"],
    ],
    "job_applications": [
        ["Application Date", "Company Name", "Job Title", "Resume Name"],
        ["03/03/24, 09:00 AM", "ACME", "Data Engineer", "cv.pdf"],
        ["05/03/24, 09:00 AM", "Umbra", "Analista", ""],
    ],
}
NOW = dt.datetime(2024, 7, 1, 12)


def write_exports(root):
    for key, lines in FILES.items():
        table = EXPORT_TABLES[key]
        path = root / f"{table.export_type}_export_2024_06_30" / table.file
        path.parent.mkdir(parents=True, exist_ok=True)
        with path.open("w", encoding="utf-8-sig" if key == "skills" else "utf-8", newline="") as out:
            if table.preamble_header:
                out.write("Notes:\nSome addresses are missing.\n\n")
            csv.writer(out, lineterminator="\n").writerows(lines)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    write_exports(root / "raw")
    found = {kind: resolve_export_dir(spark, str(root / "raw"), kind) for kind in ("basic", "complete")}
    assert all(f.source == "dated_raw_dir" for f in found.values())
    store = Warehouse(spark, str(root / "warehouse"))
    counts = load_all(spark, {kind: f.path for kind, f in found.items()}, store)
    stamp = F.lit("2024-07-01 12:00:00").cast("timestamp_ntz")
    store.replace(build_inventory(spark, {k: (f.label, f.path) for k, f in found.items()}, stamp), "bronze", "file_inventory")
    models = build_marts(store, Settings(as_of="2024-06-30"))
    run = history.Run("run-1", NOW, str(root), NOW, NOW)
    summary = build_history(store, models, run)
    return root, store, counts, models, summary


def test_loaded_rows(lake):
    _, store, counts, _, _ = lake
    assert counts == {
        "connections": 4, "positions": 2, "profile": 1, "languages": 2, "education": 2, "certifications": 1,
        "endorsement_received_info": 2, "company_follows": 1, "recommendations_received": 1, "skills": 2,
        "phone_numbers": 1, "email_addresses": 1, "registration": 1, "saved_job_alerts": 1, "volunteering": 1,
        "invitations": 1, "events": 1, "learning": 2, "job_applications": 2,
    }
    assert store.read("bronze", "ingestion_audit").count() == 19


def test_marts(lake):
    _, store, _, models, _ = lake
    months = {r.connection_year_month: r for r in models.mart("connections_summary").collect()}
    assert set(months) == {"2024-03", "2024-04", None}
    assert (months["2024-03"].total_connections, months["2024-03"].connections_with_email) == (2, 1)
    assert months["2024-03"].unique_companies == 1  # case and padding do not matter
    career = {r.start_year_month: r for r in models.mart("career_progression").collect()}
    assert career["2020-01"].avg_duration_months == 26 and career["2022-03"].avg_duration_months == 27
    health = models.mart("pipeline_health_summary").first()
    assert (health.total_inventory_files, health.successful_reads, health.failed_reads) == (19, 19, 0)
    assert (health.total_connections, health.total_skills, health.total_phone_numbers) == (4, 2, 1)
    account = models.mart("contact_account_summary").first()
    assert (account.account_age_years, account.confirmed_email_addresses) == (9, 1)
    profile = models.mart("profile_summary").first()
    assert (profile.primary_contact_url, profile.primary_contact_label) == ("https://wa.me/55", "WhatsApp")
    assert all(store.exists("main", f"mart_{name}") for name in MART_NAMES)


def test_invariants_hold(lake):
    models = lake[3]
    health = models.mart("pipeline_health_summary")
    for broken in (
        contracts.current_within_total(models.mart("career_progression")),
        contracts.email_within_total(models.mart("connections_summary")),
        contracts.reads_add_up(health),
        contracts.counters_non_negative(health),
    ):
        assert broken.count() == 0


def test_history(lake, spark):
    _, store, _, models, summary = lake
    counted = {r.table_name: (r.row_count, r.methods) for r in summary.collect()}
    assert counted["fact_snapshot_network_growth"] == (2, "cumulative_from_event_history")
    assert counted["fact_snapshot_data_quality"] == (19, "actual_pipeline_audit")
    growth = store.read("main", "fact_snapshot_network_growth").orderBy("snapshot_date").collect()
    assert [r.total_connections_cumulative for r in growth] == [2, 3]
    assert [r.connections_mom_delta for r in growth] == [0, -1]
    assert growth[0].snapshot_date == dt.date(2024, 3, 31)
    presence = {r.snapshot_year_month: r for r in store.read("main", "fact_snapshot_presence").collect()}
    april = presence["2024-04"]
    assert april.presence_score == pytest.approx(0.35 + 0.30)
    assert presence["2024-03"].presence_score == pytest.approx(0.35)
    assert store.read("main", "dim_snapshot_method").count() == 3
    build_history(store, models, history.Run("run-2", NOW, "", NOW, NOW))
    assert store.read("main", "dim_snapshot_run").count() == 2


def test_history_without_audit_marts_falls_back_on_the_audit_table(lake, spark, tmp_path):
    store, models = lake[1], lake[3]
    other = Warehouse(spark, str(tmp_path))
    with pytest.raises(LookupError, match="mart_connections_summary"):
        build_history(other, models, history.Run("run-1", NOW))
    for name in HISTORY_SOURCES:
        other.replace(store.read("main", f"mart_{name}"), "main", f"mart_{name}")
    other.replace(store.read("bronze", "ingestion_audit"), "bronze", "ingestion_audit")
    build_history(other, models, history.Run("run-1", NOW))
    quality = other.read("main", "fact_snapshot_data_quality")
    assert quality.select("snapshot_source").distinct().first()[0] == "bronze.ingestion_audit"
    assert quality.count() == 19


def test_second_load_shows_as_change(lake, spark, tmp_path):
    root = lake[0]
    store = Warehouse(spark, str(tmp_path))
    directory = str(root / "raw" / "complete_export_2024_06_30")
    for day in ("2024-07-01", "2024-08-01"):
        load_table(spark, "skills", directory, store, F.lit(day).cast("timestamp_ntz"))
    from tidemark.plans import audit_marts
    from tidemark.plans.staging import stage

    found = audit_marts.health_timeline(stage("ingestion_audit", store.read("bronze", "ingestion_audit")))
    changes = [r.row_count_change_vs_previous_load for r in found.orderBy("loaded_at_utc").collect()]
    assert changes == [None, 0]


def test_dashboards(lake):
    models = lake[3]
    assert [tuple(r) for r in insights.top_connection_companies(models, 1).collect()] == [("acme", 2)]
    assert insights.learning_overview(models).first().completion_rate == 50.0
    assert insights.recommendation_themes(models).first().dominant_theme == "equilíbrio entre data e teamwork"
    best = insights.best_endorsement_month(models).first()
    assert (best.best_month, best.best_month_total) == ("2024-04", 1)  # the later month among equals
    assert {r.export_type: r.success_rate for r in insights.export_totals(models).collect()} == {"basic": 100.0, "complete": 100.0}
    assert insights.skills_overview(models).first().top_category == "analytics"


def test_publishing(lake, spark, tmp_path):
    _, store, _, models, _ = lake
    listed = {r.output_name: r for r in exports.publish_marts(models, str(tmp_path), "both").collect()}
    assert len(listed) == 22 and listed["dim_date"].column_count == 22
    assert listed["fact_connections_timeline"].row_count == 3
    checks = exports.publish_history(store, str(tmp_path / "history")).collect()
    assert len(checks) == 7
    from tidemark.sources.publish import check_exports

    assert all(r.is_valid for r in check_exports(spark, str(tmp_path), exports.OBSERVABILITY_COLUMNS).collect())


def test_public_copy(lake, spark, tmp_path):
    source = lake[1]
    target = Warehouse(spark, str(tmp_path))
    names = build_public_copy(source, target)
    assert len(names) == len(MART_NAMES) + 7
    row = target.read("main", "mart_profile_summary").first()
    assert (row.first_name, row.last_name) == ("Pessoa 001", "Pessoa 001")
    assert row.portfolio_website == "https://example.com/portfolio"
    assert row.headline != "Analista de BI"
