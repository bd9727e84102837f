"""The whole report as a set of lazily planned tables.

Documents are normalised and deduplicated once. The resulting tables are written to the shared
folder and read back, so that every figure starts from short, typed, columnar input, no lineage
is longer than one step, and a lost executor costs a re-read and not a re-run.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from pactlens.config import ReportConfig
from pactlens.functions import calendar as cal
from pactlens.operators import dedupe as dd
from pactlens.operators import dimensions as dm
from pactlens.operators import losscodes as lc
from pactlens.operators import metrics as m
from pactlens.operators import normalize as nz
from pactlens.operators import pricing as pr
from pactlens.operators import quality as q
from pactlens.session import configure, scratch_path


_BLOCK = 16 * 1024 * 1024


class Report:
    """Tables of one report run.

    ``contract_documents`` holds both contract feeds in the shape of ``RAW_CONTRACT``,
    ``claim_documents`` the claim feed in that of ``RAW_CLAIM``.
    """

    def __init__(
        self,
        spark: SparkSession,
        cfg: ReportConfig,
        contract_documents: DataFrame,
        claim_documents: DataFrame,
        audits: DataFrame | None = None,
        materialise: bool = True,
    ):
        self.spark = configure(spark)
        self.cfg = cfg
        self.contract_documents = contract_documents
        self.claim_documents = claim_documents
        self.audits = audits
        self._materialise = materialise

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written to the shared folder and read back."""
        if not self._materialise:
            return df
        path = scratch_path(self.spark, name)
        # blocks that several tasks can share: rows take some twenty times their compressed size in memory
        df.write.option("compression", "zstd").option("parquet.block.size", _BLOCK).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # normalised and deduplicated tables

    @cached_property
    def evaluated_contracts(self) -> DataFrame:
        """All contract documents, parsed once for rows, issues and checks."""
        evaluated = nz.evaluate_contracts(self.contract_documents)
        return self.keep(nz.parsed_contracts(evaluated, self.cfg), "contract-documents")

    @cached_property
    def evaluated_claims(self) -> DataFrame:
        """All claim documents, parsed once."""
        return self.keep(nz.parsed_claims(nz.evaluate_claims(self.claim_documents)), "claim-documents")

    @cached_property
    def all_contract_rows(self) -> DataFrame:
        """Normalised contract rows of all dates, with whole curves; read from the parsed documents."""
        return nz.contract_rows(self.evaluated_contracts)

    @cached_property
    def contract_rows(self) -> DataFrame:
        return nz.contracts_as_of(self.all_contract_rows, self.cfg)

    @cached_property
    def all_claim_rows(self) -> DataFrame:
        """Normalised payment lines of all dates; read from the parsed documents."""
        return nz.claim_rows(self.evaluated_claims)

    @cached_property
    def claim_rows(self) -> DataFrame:
        return nz.claims_as_of(self.all_claim_rows, self.cfg)

    @cached_property
    def ledger(self) -> DataFrame:
        rows = nz.contract_rows(nz.reporting_curves(self.evaluated_contracts, self.cfg))
        return self.keep(dd.contract_ledger(nz.contracts_as_of(rows, self.cfg)), "ledger")

    @cached_property
    def transactions(self) -> DataFrame:
        """The sides of the ledger, read from it: a user reads no more columns than it needs."""
        return dd.contract_transactions(self.ledger, self.cfg)

    @cached_property
    def claims(self) -> DataFrame:
        return self.keep(dd.dedupe_claims(self.claim_rows), "claims")

    @cached_property
    def issues(self) -> DataFrame:
        """Problems of raw documents, written once for all users."""
        found = nz.contract_issues(self.evaluated_contracts, self.cfg)
        return self.keep(found.unionByName(nz.claim_issues(self.evaluated_claims)), "issues")

    # periods

    @cached_property
    def periods(self) -> DataFrame:
        return cal.period_frame(self.spark, cal.horizons(self.cfg) + cal.months(self.cfg))

    @cached_property
    def dimension_periods(self) -> DataFrame:
        return cal.period_frame(self.spark, cal.pick(self.cfg, *cal.DIMENSION_HORIZONS))

    # figures

    @cached_property
    def metrics(self) -> DataFrame:
        """A row per period, written once: its users ask for parts of it or write it several times."""
        return self.keep(m.period_metrics(self.ledger, self.claims, self.periods), "metrics")

    @cached_property
    def lookup(self) -> DataFrame:
        return dd.contract_lookup(self.ledger)

    @cached_property
    def partners(self) -> DataFrame:
        """Which agents a dealer and which dealers an agent has in a period, a row each."""
        state = m.ledger_state(self.ledger, ["dealer", "agent"])
        return self.keep(dm.related_pairs(state, self.dimension_periods), "partners")

    def dimension_table(self, dims: list[str]) -> DataFrame:
        return dm.dimension_metrics(
            self.ledger, self.claims, self.lookup, self.dimension_periods, dims, partners=self.partners
        )

    @cached_property
    def dimensions(self) -> DataFrame:
        """Dealer, agent and product metrics of the four horizons, written once for all users."""
        return self.keep(self.dimension_table(dm.DIMENSIONS), "dimensions")

    @cached_property
    def entity_keys(self) -> DataFrame:
        return self.keep(dd.entity_keys(self.dimensions), "entity-keys")

    def of_entities(self, rows: DataFrame, dim: str, code: str, name: str) -> DataFrame:
        return dd.entity_rows(rows, self.entity_keys, dim, code, name)

    def sums_of_entities(
        self, rows: DataFrame, dim: str, code: str, name: str, groups: list[str], sums: list[str],
        firsts: list[str] = (),
    ) -> DataFrame:
        return dd.entity_sums(rows, self.entity_keys, dim, code, name, groups, sums, firsts)

    def dimension(self, dim: str, period_id: str) -> DataFrame:
        return self.dimensions.where(f"dim = '{dim}' AND period_id = '{period_id}'")

    @cached_property
    def loss_codes(self) -> DataFrame:
        return lc.loss_code_rows(self.claims, self.cfg)

    @cached_property
    def benchmark(self) -> DataFrame:
        """Payment statistics per loss code and make."""
        return pr.claim_benchmark(self.claims, lambda df: self.keep(df, "amounts"))

    @cached_property
    def source_counts(self) -> DataFrame:
        return q.source_counts(
            self.contract_documents, self.claim_documents, self.transactions, self.claims, self.issues
        )
