"""All models over one set of bronze tables, built on demand and at most once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.plans import audit_marts, history, marts, suite
from tidemark.plans.enriched import Settings, enrich
from tidemark.plans.staging import stage
from tidemark.sources.swap import fresh_directory
from tidemark.sources.warehouse import Warehouse


class Models:
    """Lazy staging -> enriched -> mart -> history chain.

    ``bronze`` maps a table name to its DataFrame. ``marts_from`` reads marts
    that were already written, so that history and dashboards do not recompute
    them.
    """

    def __init__(
        self,
        bronze: Callable[[str], DataFrame],
        settings: Settings | None = None,
        marts_from: Callable[[str], DataFrame] | None = None,
    ) -> None:
        self._bronze = bronze
        self.settings = settings or Settings()
        self._stored_mart = marts_from
        self._built: dict[tuple[str, str], DataFrame] = {}

    def _once(self, kind: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        key = (kind, name)
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]

    def bronze(self, table: str) -> DataFrame:
        return self._once("bronze", table, lambda: self._bronze(table))

    def staged(self, table: str) -> DataFrame:
        return self._once("staged", table, lambda: stage(table, self.bronze(table)))

    def enriched(self, table: str) -> DataFrame:
        return self._once("enriched", table, lambda: enrich(table, self.staged(table), self.settings))

    def countable(self, table: str) -> DataFrame:
        """Something with as many rows as the table's model, to count them.

        Staging and enriched models are projections, so that is the bronze
        table itself, with nothing of the model to plan.
        """
        return self.bronze(table)

    def mart(self, name: str) -> DataFrame:
        return self._once("mart", name, lambda: self._mart(name))

    def _mart(self, name: str) -> DataFrame:
        if self._stored_mart is not None:
            return self._stored_mart(name)
        if name in marts.SUMMARIES:
            table, build = marts.SUMMARIES[name]
            return build(self.enriched(table))
        if name == "contact_account_summary":
            parts = [self.staged(t) for t in ("email_addresses", "phone_numbers", "registration")]
            return marts.contact_account_summary(*parts, settings=self.settings)
        if name == "pipeline_health_summary":
            tables = {t: self.countable(t) for t in marts.HEALTH_COUNTERS.values()}
            return marts.load_health_summary(self.staged("file_inventory"), tables)
        if name == "ingestion_audit_health_timeline":
            return audit_marts.health_timeline(self.staged("ingestion_audit"))
        if name == "ingestion_audit_null_rate_timeline":
            return audit_marts.null_rate_timeline(self.staged("ingestion_audit"))
        raise KeyError(name)

    def history(self, name: str, run: history.Run) -> DataFrame:
        return self._once("history", name, lambda: history.FACTS[name](self, run))


MART_NAMES = (
    *marts.SUMMARIES,
    "contact_account_summary",
    "pipeline_health_summary",
    "ingestion_audit_health_timeline",
    "ingestion_audit_null_rate_timeline",
)


def build_marts(warehouse: Warehouse, settings: Settings | None = None, tested: bool = False) -> Models:
    """Write every mart from the bronze layer and return models that read the written ones.

    With ``tested`` the declared data tests run on what was written, and a failing one raises.
    """
    models = Models(lambda table: warehouse.read("bronze", table), settings)
    for name in MART_NAMES:
        warehouse.replace(models.mart(name), "main", f"mart_{name}")
    if tested:
        suite.require_layer("mart", lambda name: warehouse.read("main", f"mart_{name}"))
    return Models(
        lambda table: warehouse.read("bronze", table), settings, lambda name: warehouse.read("main", f"mart_{name}")
    )


# Marts the history facts cannot do without; the audit marts have a fallback.
HISTORY_SOURCES = (
    "connections_summary",
    "job_applications_summary",
    "events_summary",
    "invitations_summary",
    "recommendations_received_timeline",
    "career_progression",
    "education_summary",
    "certifications_summary",
)
AUDIT_MARTS = ("ingestion_audit_health_timeline", "ingestion_audit_null_rate_timeline")


def build_history(warehouse: Warehouse, models: Models, run: history.Run) -> DataFrame:
    """Write all history facts aside, check what was written against the contracts, then publish it; nothing is published if any check fails.

    Without the audit marts the data-quality fact comes from the bare audit table.
    """
    warehouse.require([("main", f"mart_{name}") for name in HISTORY_SOURCES])
    audited = all(warehouse.exists("main", f"mart_{name}") for name in AUDIT_MARTS)
    facts = {
        name: models.history(name, run)
        for name in history.FACTS
        if audited or name != "fact_snapshot_data_quality"
    }
    if not audited:
        audit = warehouse.read("bronze", "ingestion_audit")
        facts["fact_snapshot_data_quality"] = history.data_quality_from_audit(audit, run)
    spark = warehouse.spark
    with fresh_directory(spark, warehouse.root) as staging:
        for name, fact in facts.items():
            fact.write.parquet(f"{staging}/{name}")
        written = {name: spark.read.parquet(f"{staging}/{name}") for name in facts}
        history.require_valid(written)
        for name, fact in written.items():
            warehouse.replace(fact, "main", name)
    warehouse.replace(history.method_dimension(spark), "main", "dim_snapshot_method")
    warehouse.append(history.run_dimension(spark, run), "main", "dim_snapshot_run", load=run.run_id)
    return history.summarize({name: warehouse.read("main", name) for name in facts})
