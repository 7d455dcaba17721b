"""Wiring of all datasets in dependency order, for one set of input tables."""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from payledger.config import LedgerConfig
from payledger.operators.joins import HotKeys, columns_read, materialize, source_bytes, widened, write_once, written
from payledger.plans import calendar, currency, documents, masterdata, payables


class LedgerModel:
    """Lazily built datasets over ``tables`` (ERP table name -> DataFrame).

    Each property is the plan a ``create view`` would give in a SQL warehouse;
    only the small dimensions are written when first used. "Today" is fixed when
    the model is made, so all datasets agree on it.

    ``stored`` gives already persisted datasets by property name (currency_decimal,
    currency_conversion, business_days, calendar, or any view): they are read instead
    of built, also by the datasets that build on them. A stored calendar also
    provides the calendar attributes of the documents.
    """

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame], cfg: LedgerConfig,
                 stored: Mapping[str, DataFrame] | None = None):
        self.spark = spark
        self.tables = tables
        if cfg.as_of is None:
            cfg = dataclasses.replace(cfg, as_of=spark.range(1).select(F.current_date()).first()[0])
        self.cfg = cfg
        self.__dict__.update(stored or {})
        self.stored_calendar = (stored or {}).get("calendar")
        self.stored_invoices = (stored or {}).get("invoices")
        self.stored_documents = (stored or {}).get("accounting_documents")
        self._stored_rows: dict[frozenset[str], DataFrame] = {}

    def _dimension(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name) if self.cfg.materialize_dimensions else df

    # helpers
    @cached_property
    def currency_decimal(self) -> DataFrame:
        return self._dimension(currency.currency_decimal(self.tables), "currency-decimal")

    @cached_property
    def currency_lookup(self) -> DataFrame | currency.CurrencyFactors:
        """The currency table as values where it is small, else the table."""
        factors = currency.currency_factors(self.currency_decimal, self.cfg.currency_values)
        return self.currency_decimal if factors is None else factors

    @cached_property
    def currency_conversion(self) -> DataFrame:
        return currency.currency_conversion(self.tables, self.cfg)

    @cached_property
    def currency_conversion_view(self) -> DataFrame:
        return currency.currency_conversion_view(self.currency_conversion)

    @cached_property
    def calendar(self) -> DataFrame:
        return calendar.calendar_date_dim(self.spark, self.cfg.calendar_start, self.cfg.calendar_end)

    @cached_property
    def business_days(self) -> DataFrame:
        return self._dimension(calendar.business_day_table(self.tables, self.spark, self.cfg), "business-days")

    # master data
    @cached_property
    def companies(self) -> DataFrame:
        return masterdata.companies_md(self.tables)

    @cached_property
    def customers(self) -> DataFrame:
        return masterdata.customers_md(self.tables, self.cfg)

    @cached_property
    def vendors(self) -> DataFrame:
        return masterdata.vendors_md(self.tables)

    @cached_property
    def vendor_config(self) -> DataFrame:
        return masterdata.vendor_config(self.tables)

    # documents
    @cached_property
    def invoices(self) -> DataFrame:
        return documents.invoice_documents_flow(self.tables, self.currency_lookup, self.stored_calendar, self.cfg)

    @cached_property
    def payable_invoice_flow(self) -> DataFrame:
        """The invoice flow as far as the payable fact needs it: the stored flow when
        there is one, else the lines merged and joined to their headers once, written,
        and read by both branches of the fact (posted and parked)."""
        if self.stored_invoices is not None:
            return self.stored_invoices
        if not self.cfg.share_invoice_lines:
            return self.invoices
        lines = documents.invoice_lines(self.tables, fields=documents.PAYABLE_LINE_FIELDS)
        flow = documents.invoice_documents_flow(self.tables, self.currency_lookup, self.stored_calendar, self.cfg, lines=lines)
        return write_once(flow.select(*payables.INVOICE_FLOW_COLUMNS), "payable-invoices")

    @cached_property
    def parked_invoice_flow(self) -> DataFrame:
        """The invoice flow of parked invoices; ``parked_invoices`` filters a flow of all."""
        if self.stored_invoices is not None or self.cfg.share_invoice_lines:
            return self.payable_invoice_flow
        return documents.invoice_documents_flow(
            self.tables, self.currency_lookup, self.stored_calendar, self.cfg, F.col("rbstat") == self.cfg.parked_status)

    @cached_property
    def purchase_history(self) -> DataFrame:
        return documents.purchase_documents_history(self.tables, self.currency_lookup, self.stored_calendar, self.cfg)

    @cached_property
    def accounting_documents(self) -> DataFrame:
        return documents.accounting_documents(self.tables, self.currency_lookup, self.stored_calendar, self.cfg)

    # payables
    @cached_property
    def hot_keys(self) -> dict[str, HotKeys]:
        if self.cfg.hot_key_share is None:
            return {}
        return payables.hot_join_keys(self.accounting_documents, self.cfg, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    @cached_property
    def stores_fact(self) -> bool:
        """Whether the joins of the payable fact are jobs of their own (``store_fact_bytes``)."""
        limit = self.cfg.store_fact_bytes
        return limit is not None and source_bytes(self.accounting_documents.select("AccountingDocumentNumber_BELNR")) >= limit

    @cached_property
    def payable_rows(self) -> DataFrame:
        return payables.payable_rows(self.accounting_documents, self.payable_invoice_flow, self.cfg,
                                     self.parked_invoice_flow, self.hot_keys.get("invoice"))

    def _store_rows(self, columns: list[str]) -> DataFrame:
        """These columns of ``payable_rows``, stored: the vendor lines are written first (joined
        to their headers), then they meet the invoice flow, so each job shuffles for one of
        the joins only. Rows stored before are read if they have the columns."""
        for names, rows in self._stored_rows.items():
            if names.issuperset(columns):
                return rows

        def rows_of(lines):
            return payables.payable_rows(lines, self.payable_invoice_flow, self.cfg, self.parked_invoice_flow,
                                         self.hot_keys.get("invoice"), True).select(*columns)

        if self.stored_documents is not None:
            rows = write_once(rows_of(self.stored_documents), "payable-rows")
        else:
            self.hot_keys, self.payable_invoice_flow  # noqa: B018 - made before the lines are written
            lines = payables.vendor_lines(self.accounting_documents, self.cfg)
            with written(lines.select(*columns_read(rows_of, self.spark, lines.schema)), "payable-lines") as kept:
                rows = write_once(rows_of(widened(kept, lines.schema)), "payable-rows")
        self._stored_rows[frozenset(columns)] = rows
        return rows

    @cached_property
    def accounting_invoices(self) -> DataFrame:
        self.prepare_dimensions()
        return payables.accounting_invoices(self.payable_rows, self.business_days, self.cfg)

    @cached_property
    def fiscal_periods(self) -> DataFrame:
        keys = payables.fiscal_keys_from_headers(self.tables, self.companies)
        return self._dimension(payables.fiscal_period_dimension(
            self.companies, keys, self.tables["t009"], self.tables["t009b"], self.cfg), "fiscal-periods")

    @cached_property
    def target_rates(self) -> DataFrame:
        if self.cfg.rate_lookup == "interval":
            return self._dimension(currency.target_rate_months(self.tables, self.cfg), "target-rates")
        if self.cfg.rate_lookup != "daily":
            raise ValueError(f"unknown rate_lookup {self.cfg.rate_lookup!r}")
        return self._dimension(currency.target_rates(self.currency_conversion_view, self.cfg), "target-rates")

    @cached_property
    def current_vendors(self) -> DataFrame:
        return self._dimension(payables.current_vendors(self.vendors, self.cfg), "current-vendors")

    @cached_property
    def company_dimension(self) -> DataFrame:
        return self._dimension(payables.company_dimension(self.companies, self.fiscal_periods, self.cfg), "companies")

    def prepare_dimensions(self) -> None:
        """Write the small dimensions and the shared invoice flow concurrently: they
        are independent jobs, and running them side by side keeps the cores busy."""
        names = ["currency_decimal", "business_days", "target_rates", "current_vendors", "company_dimension"]
        if self.cfg.share_invoice_lines and self.stored_invoices is None:
            names.append("payable_invoice_flow")
        todo = [n for n in names if n not in self.__dict__]
        if not self.cfg.materialize_dimensions or len(todo) < 2:
            return
        if "payable_invoice_flow" in todo:
            self.currency_lookup  # noqa: B018 - the flow needs it: not made twice
            todo = [n for n in todo if n not in self.__dict__]
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            for name, df in zip(todo, pool.map(lambda n: getattr(self, n), todo)):
                self.__dict__.setdefault(name, df)

    @cached_property
    def accounting_invoices_kpi(self) -> DataFrame:
        self.prepare_dimensions()
        return payables.accounting_invoices_kpi(
            self.accounting_invoices, self.company_dimension, self.business_days, self.fiscal_periods, self.cfg,
        )

    @cached_property
    def enriched_payables(self) -> DataFrame:
        return payables.enrich(
            self.accounting_invoices_kpi, self.current_vendors, self.vendor_config, self.purchase_history,
            self.target_rates, self.cfg, hot=self.hot_keys.get("purchase"),
        )

    def _fact_of(self, rows: DataFrame) -> DataFrame:
        """The payable fact of stored rows. They meet the PO history before the lookups:
        what these add is not shuffled."""
        rows = payables.add_purchase_history(rows, self.purchase_history, self.hot_keys.get("purchase"), nulls_apart=True)
        kpi = payables.accounting_invoices_kpi(
            payables.accounting_invoices(rows, self.business_days, self.cfg),
            self.company_dimension, self.business_days, self.fiscal_periods, self.cfg,
        )
        kpi = payables.enrich(kpi, self.current_vendors, self.vendor_config, None, self.target_rates, self.cfg)
        return payables.accounts_payable(kpi, self.cfg)

    @cached_property
    def payable_plan(self) -> DataFrame:
        """The payable fact as a single plan: its shuffle files stay until it has run."""
        return payables.accounts_payable(self.enriched_payables, self.cfg)

    def payables(self, columns: Sequence[str] = tuple(payables.OUTPUT_COLUMNS)) -> DataFrame:
        """Columns of the payable fact. Where it is large (``store_fact_bytes``) its rows
        are stored between the joins, as far as these columns need them."""
        if not self.stores_fact:
            return self.payable_plan.select(*columns)
        self.prepare_dimensions()

        schema = self.payable_rows.schema

        def fact(rows):
            return self._fact_of(rows).select(*columns)

        return fact(widened(self._store_rows(columns_read(fact, self.spark, schema)), schema))

    @cached_property
    def accounts_payable(self) -> DataFrame:
        return self.payables()
