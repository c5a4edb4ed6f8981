"""Per-dataset build context: the canonical tables and marts as lazy plans.

Plans and written tables are memoised per (session, data folder), so the
registry's many entry points share them. Nothing here is cached in memory.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from patronage.config import CUSTOMER_KEY, TESTDATA_PARAMS, Params
from patronage.operators.clean import Ledger, clean_all
from patronage.operators.marts import build_orders, build_transactions
from patronage.session import materialize
from patronage.sources.layout import bucketed
from patronage.sources.testdata import canonical_tables, purchase_events


@dataclass
class Context:
    spark: SparkSession
    sf_dir: str
    params: Params = TESTDATA_PARAMS
    _memo: dict = field(default_factory=dict)

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    @property
    def raw(self) -> dict[str, DataFrame]:
        return self._get("raw", lambda: canonical_tables(self.spark, self.sf_dir))

    def _marts(self):
        """Clean tables and the order-line mart, each written once to the shared
        checkpoint folder (the ETL → analytics boundary; all else reads them),
        and the ledger of what the writes dropped."""
        def build():
            clean, ledger = clean_all(self.raw, self.params, Ledger())
            return clean, build_transactions(clean, ledger), ledger
        return self._get("marts", build)

    @property
    def clean(self) -> dict[str, DataFrame]:
        return self._marts()[0]

    @property
    def transactions(self) -> DataFrame:
        return self._marts()[1]

    @property
    def ledger(self) -> Ledger:
        return self._marts()[2]

    @property
    def orders(self) -> DataFrame:
        return self._get("orders", lambda: materialize(build_orders(self.transactions)))

    @property
    def customer_orders(self) -> DataFrame:
        """The order mart laid out by customer."""
        return self._get("customer_orders", lambda: bucketed(self.orders, CUSTOMER_KEY, ["order_purchase_timestamp"]))

    @property
    def purchases(self) -> DataFrame:
        return self._get("purchases", lambda: purchase_events(self.spark, self.sf_dir))


_CONTEXTS: dict[tuple[str, str], Context] = {}


def context(spark: SparkSession, sf_dir: str) -> Context:
    app = spark.sparkContext.applicationId
    for old in [k for k in _CONTEXTS if k[0] != app]:  # frames of a session that has ended
        del _CONTEXTS[old]
    key = (app, sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Context(spark, sf_dir.rstrip("/"))
    return _CONTEXTS[key]
