"""Tables of one data folder at every layer, and the check queries' shared helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from riskmart.functions.scalars import round_half_up
from riskmart.operators.staging import STAGING, applicant_keys
from riskmart.plans import run
from riskmart.plans.marts import portfolio_summary, training_table
from riskmart.session import stage
from riskmart.sources import credit_binding

_written: dict[tuple[str, str, str], DataFrame] = {}


class LazyTables(Mapping[str, DataFrame]):
    """Tables by name, each plan built on first use."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built = dict(builders), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


class Bound:
    """Raw, staged, feature and mart tables bound to ``sf_dir``.

    ``raw``, ``staged`` and ``ints`` are lazy. ``features`` and ``fact`` are written once per application,
    as the layers they are, and report queries read them back.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def source(self, name: str) -> DataFrame:
        return credit_binding.table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> Mapping[str, DataFrame]:
        return LazyTables({n: lambda f=f: f(self.spark, self.sf_dir) for n, f in credit_binding.RAW_TABLES.items()})

    @cached_property
    def staged(self) -> Mapping[str, DataFrame]:
        return LazyTables({n: lambda src=src, step=step: step(self.raw[src]) for n, (src, step) in STAGING.items()})

    @cached_property
    def ints(self) -> Mapping[str, DataFrame]:
        return LazyTables({n: lambda step=step: step(self.staged) for n, step in run.FEATURE_STEPS.items()})

    def fact_plan(self, **options) -> DataFrame:
        return run.fact_of(self.staged, self.ints, **options)

    def written(self, name: str, df: Callable[[], DataFrame]) -> DataFrame:
        """The table as written by the run, once per application and data folder."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _written:
            _written[key] = stage(df(), name)
        return _written[key]

    @cached_property
    def features(self) -> Mapping[str, DataFrame]:
        """The roll-ups as written tables."""
        return LazyTables({n: lambda n=n: self.written(n, lambda: self.ints[n]) for n in run.FEATURE_STEPS})

    @cached_property
    def fact(self) -> DataFrame:
        return self.written(run.FACT, lambda: run.fact_of(self.staged, self.features))

    @cached_property
    def training(self) -> DataFrame:
        return training_table(self.fact)

    @cached_property
    def parents(self) -> Mapping[str, DataFrame]:
        """The staged applicants, written as their keys alone: a check of references needs no fact."""
        return LazyTables({"stg_application_train": lambda: self.written(
            "reference-keys", lambda: applicant_keys(self.raw["application_train"]))})

    @cached_property
    def tables(self) -> Mapping[str, DataFrame]:
        """All tables by name; only those that are asked for are built."""
        built = {n: lambda n=n, side=side: side[n] for side in (self.staged, self.features) for n in side}
        return LazyTables({**built, run.FACT: lambda: self.fact, run.SUMMARY: lambda: portfolio_summary(self.fact),
                           run.TRAINING: lambda: self.training})


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Output columns without the noise of summing doubles."""
    return df.withColumns({c: round_half_up(c, digits) for c in cols})


def cast_long(df: DataFrame, *cols: str) -> DataFrame:
    from pyspark.sql import functions as F

    return df.withColumns({c: F.col(c).cast("long") for c in cols})
