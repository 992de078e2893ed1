"""Model chain over the driver tables, shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factorloom.operators.clean import with_audit
from factorloom.plans import cleaned, factors, panel, scores, serving
from factorloom.session import cut_lineage
from suite import inputs
from suite.inputs import CTX


class Models:
    """Every model on one folder of tables, each built once per instance.

    Tables several models read are cut from their lineage, as a scheduled run would store
    them between steps.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._stored: list[DataFrame] = []
        self._quotes_read = False

    def _once(self, name: str, build, stored: bool = False) -> DataFrame:
        if name not in self._built:
            df = build()
            if stored:
                df = cut_lineage(df, name)
                self._stored.append(df)
            self._built[name] = df
        return self._built[name]

    def intact(self) -> bool:
        """Whether the stored steps are still where they were written."""
        conf = self.spark._jsc.hadoopConfiguration()
        for df in self._stored:
            for file in df.inputFiles()[:1]:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(file)
                if not path.getFileSystem(conf).exists(path):
                    return False
        return True

    def cells(self) -> DataFrame:
        return self._once("cells", lambda: inputs.cells(self.spark, self.sf_dir), True)

    def landed_reports(self) -> DataFrame:
        return self._once("landed", lambda: inputs.reports(
            self.spark, self.sf_dir, self.cells()), True)

    def statement(self, kind: str) -> DataFrame:
        return self._once(kind, lambda: cleaned.statement(self.landed_reports(), kind, CTX))

    def fundamental_quarter(self) -> DataFrame:
        return self._once("fq", lambda: cleaned.fundamental_quarter(
            cleaned.stage_fundamental_quarter(
                inputs.fundamental_quarters(self.spark, self.sf_dir, self.cells()), CTX)))

    def companies(self) -> DataFrame:
        return self._once("companies", lambda: cleaned.companies(
            inputs.company_list(self.spark, self.sf_dir), inputs.KEY_PATTERN))

    def fundamental_1(self) -> DataFrame:
        return self._once("fun1", lambda: cleaned.fundamental_1(
            cleaned.stage_fundamental_1(inputs.fundamentals_1(self.spark, self.sf_dir))))

    def fundamental_2(self) -> DataFrame:
        return self._once("fun2", lambda: cleaned.fundamental_2(
            cleaned.stage_fundamental_2(inputs.fundamentals_2(self.spark, self.sf_dir))))

    def dim_company(self) -> DataFrame:
        return self._once("dim", lambda: with_audit(cleaned.dim_company(
            self.companies(), self.fundamental_1(), self.fundamental_2()), "gold", CTX), True)

    def macro(self) -> DataFrame:
        return self._once("macro", lambda: inputs.macro(self.spark, self.sf_dir))

    def panel(self) -> DataFrame:
        return self._once("panel", lambda: panel.financial_panel(
            self.statement("income_statement"), self.statement("balance_sheet"),
            self.statement("cash_flow"), self.fundamental_quarter(), self.dim_company()))

    def ttm(self) -> DataFrame:
        return self._once("ttm", lambda: panel.ttm_metrics(self.panel(), self.macro()), True)

    def quotes(self) -> DataFrame:
        return self._once("quotes", self._quotes, True)

    def quotes_for_one(self) -> DataFrame:
        """Quotes for a model that reads them once and is stored itself, or moves them no further.

        The first such model takes them as they are made: nothing is written or read again, and
        rows stay where the quotes have put them, by company and day.  With the second reader they
        are stored for all that follow.
        """
        if "quotes" in self._built or self._quotes_read:
            return self.quotes()
        self._quotes_read = True
        return self._quotes()

    def _quotes(self) -> DataFrame:
        return cleaned.quotes(cleaned.stage_quotes(
            inputs.quotes_landing(self.spark, self.sf_dir), CTX))

    def profitability(self) -> DataFrame:
        return self._once("prof", lambda: factors.profitability(self.ttm(), CTX))

    def growth(self) -> DataFrame:
        return self._once("grow", lambda: factors.growth(self.ttm(), CTX))

    def altman(self) -> DataFrame:
        return self._once("alt", lambda: factors.altman_z(self.ttm(), CTX))

    def ohlson(self) -> DataFrame:
        return self._once("ohl", lambda: factors.ohlson_o(self.ttm(), CTX))

    def beta_vol(self) -> DataFrame:
        return self._once("vol", lambda: factors.beta_vol(self.quotes_for_one(), CTX))

    def beta_bab(self) -> DataFrame:
        return self._once("bab", lambda: factors.beta_bab(self.beta_vol()), True)

    def safety(self) -> DataFrame:
        return self._once("safety", lambda: factors.safety(
            self.ttm(), self.beta_bab(), self.altman(), self.ohlson()))

    def raw(self, pillar: str) -> DataFrame:
        return {"profitability": self.profitability, "growth": self.growth,
                "safety": self.safety}[pillar]()

    def components(self, pillar: str) -> DataFrame:
        return self._once(f"sc_{pillar}", lambda: scores.score_components(
            self.raw(pillar), pillar), True)

    def pillar(self, pillar: str) -> DataFrame:
        return self._once(f"pl_{pillar}", lambda: scores.pillar_score(
            self.components(pillar), pillar))

    def qmj(self) -> DataFrame:
        return self._once("qmj", lambda: scores.qmj_final(
            self.pillar("profitability"), self.pillar("growth"), self.pillar("safety")), True)

    def value_hist(self) -> DataFrame:
        return self._once("val", lambda: factors.value_hist(self.ttm(), CTX))

    def value_recent(self) -> DataFrame:
        return self._once("valr", lambda: factors.value_recent(
            self.ttm(), self.dim_company(), CTX))

    def momentum_hist(self) -> DataFrame:
        return self._once("mom", lambda: factors.momentum_hist(self.quotes_for_one(), CTX), True)

    def momentum_recent(self) -> DataFrame:
        return self._once("momr", lambda: factors.momentum_recent(
            self.quotes_for_one(), CTX), True)

    def value_momentum(self) -> DataFrame:
        return self._once("vm", lambda: scores.value_momentum_z(
            self.value_hist(), self.momentum_hist()))

    def value_momentum_live(self) -> DataFrame:
        return self._once("vml", lambda: scores.value_momentum_z_live(
            self.value_recent(), self.momentum_recent()))

    def obt(self) -> DataFrame:
        if "obt" not in self._built and "bab" not in self._built:
            self.quotes()  # three models are going to read them
        return self._once("obt", lambda: serving.obt_web(
            self.qmj(), self.value_momentum(), self.value_momentum_live(), self.dim_company(),
            self.fundamental_quarter()), True)


_HELD: dict[tuple[str, str], Models] = {}


def models(spark: SparkSession, sf_dir: str) -> Models:
    """The model chain of one application and folder: later queries read stored tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _HELD or not _HELD[key].intact():
        _HELD[key] = Models(spark, sf_dir)
    return _HELD[key]


def forget() -> None:
    """Let the next query build every model again, as a measurement needs it."""
    _HELD.clear()
