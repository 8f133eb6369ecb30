"""The profile collection: five lazy tables and the operations on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove import model
from callgrove.operators import algebra, dimensions, inspection, stats
from callgrove.operators.tree import TreeSize, measure, with_depth, with_paths
from callgrove.sources import tables


class Profile:
    """Many call-path profiles as five tables; nothing runs until an action.

    ``experiment_id`` names the one experiment of a pinned profile; algebra on
    pinned profiles ignores the ids, on others it works experiment by experiment.
    """

    def __init__(
        self,
        experiments: DataFrame,
        metrics: DataFrame,
        locations: DataFrame,
        cnodes: DataFrame,
        facts: DataFrame,
        *,
        experiment_id: int | None = None,
    ) -> None:
        self.experiments = experiments
        self.metrics = metrics
        self.locations = locations
        self.cnodes = cnodes
        self.facts = facts
        self.experiment_id = experiment_id
        self._tree: DataFrame | None = None
        self._tree_size: TreeSize | None = None
        self._seen_metrics: set[str] = set()
        self._threads_checked = False
        #: Whether every fact's node is known to be in the tree.
        self._nodes_checked = False

    @property
    def pinned(self) -> bool:
        """Whether the profile is known to hold a single experiment."""
        return self.experiment_id is not None

    @property
    def tree(self) -> DataFrame:
        """Call-tree nodes with depth and root paths; built once if not stored."""
        if self._tree is None:
            stored = set(model.PATH_COLUMNS.fieldNames()) <= set(self.cnodes.columns)
            self._tree = with_depth(self.cnodes) if stored else with_paths(self.cnodes)
        return self._tree

    @property
    def tree_size(self) -> TreeSize:
        """Size of the tree, measured once; decides how facts are joined with it."""
        if self._tree_size is None:
            self._tree_size = measure(self.tree)
        return self._tree_size

    def seen_metrics(self, names: set[str]) -> set[str]:
        """Those of ``names`` that some experiment has."""
        unseen = names - self._seen_metrics
        if unseen:
            found = self.metrics.where(F.col("metric").isin(list(unseen)))
            self._seen_metrics |= {row.metric for row in found.select("metric").distinct().collect()}
        return names & self._seen_metrics

    def check_threads(self) -> None:
        """Raise :class:`KeyCheckError` unless every fact's thread has a location; once.

        Statistics and algebra need the locations of all facts. Collections that
        :meth:`write` stored are known to have them.
        """
        if not self._threads_checked:
            tables.refuse_unknown_threads(self)
            self._threads_checked = True

    def experiment(self, experiment_id: int) -> Profile:
        """The given experiment alone (partition pruning on stored tables)."""
        only = F.col("experiment_id") == experiment_id
        part = Profile(
            self.experiments.where(only),
            self.metrics.where(only),
            self.locations.where(only),
            self.cnodes.where(only),
            self.facts.where(only),
            experiment_id=experiment_id,
        )
        if self._tree is not None:
            part._tree = self._tree.where(only)
        part._threads_checked = self._threads_checked
        part._nodes_checked = self._nodes_checked
        return part

    # Storage

    @classmethod
    def load(cls, spark: SparkSession, path: str, experiment_id: int | None = None) -> Profile:
        """Open a stored collection, or one experiment of it."""
        profile = cls(**tables.read(spark, path))
        unknown = tables.unknown_nodes(spark, path)
        profile._threads_checked = unknown is not None
        profile._nodes_checked = unknown == 0
        return profile if experiment_id is None else profile.experiment(experiment_id)

    def write(self, path: str) -> Profile:
        """Store the collection in a new folder, root paths included, and reopen it."""
        tables.write(self, path)
        stored = Profile.load(self.facts.sparkSession, path)
        stored.experiment_id = self.experiment_id
        return stored

    # Dimensions

    @property
    def metric_tree(self) -> DataFrame:
        return dimensions.metric_tree(self)

    @property
    def system_tree(self) -> DataFrame:
        return dimensions.system_tree(self)

    @property
    def cnode_tree(self) -> DataFrame:
        return dimensions.cnode_tree(self)

    # Inspection

    def values(self, metric: str) -> DataFrame:
        return inspection.metric_values(self, metric)

    def info_basic(self) -> DataFrame:
        return inspection.info_basic(self)

    def info(self, metric: str = "time") -> DataFrame:
        return inspection.info(self, metric)

    def calltree(
        self,
        metric: str = "time",
        threshold: float = 0.0,
        inclusive: bool = True,
        *,
        combined: bool = False,
    ) -> DataFrame:
        return inspection.calltree(self, metric, threshold, inclusive, combined)

    def dump(
        self,
        metrics: Sequence[str] = ("time",),
        cnodes: str = "all",
        threads: str = "aggr",
        z: str = "excl",
    ) -> DataFrame:
        return inspection.dump(self, metrics, cnodes, threads, z)

    def stat(
        self,
        metrics: Sequence[str] = ("time",),
        routines: Sequence[str] | None = None,
        top_n: int | None = None,
        per_thread: bool = False,
        *,
        ddof: int = 1,
        quartiles: bool = False,
        rank_error: float | None = None,
    ) -> DataFrame:
        """Statistics of routines, see :mod:`callgrove.operators.stats`.

        ``per_thread`` takes them over the nodes of a routine on each thread.  ``rank_error``
        lets quartiles be off by that share of the sample's ranks, for far less work.
        """
        if per_thread:
            if top_n is not None or quartiles:
                raise ValueError("per_thread goes with neither top_n nor quartiles")
            return stats.thread_stats(self, metrics, routines, ddof=ddof)
        if top_n is not None:
            return stats.flat_profile(self, top_n)
        return stats.routine_stats(
            self, metrics, routines, ddof=ddof, quartiles=quartiles, rank_error=rank_error
        )

    # Algebra

    def diff(
        self,
        other: Profile,
        system_dim: model.SystemDimension = model.SystemDimension.KEEP,
        output_dir: str | None = None,
    ) -> Profile:
        """This profile minus ``other``."""
        return _stored(algebra.diff(self, other, system_dim=system_dim), output_dir)

    @staticmethod
    def merge(
        *profiles: Profile,
        system_dim: model.SystemDimension = model.SystemDimension.KEEP,
        output_dir: str | None = None,
    ) -> Profile:
        """Union of the metrics; a shared metric comes from the first that has it."""
        return _stored(algebra.merge(*profiles, system_dim=system_dim), output_dir)

    @staticmethod
    def mean(
        *profiles: Profile,
        system_dim: model.SystemDimension = model.SystemDimension.KEEP,
        output_dir: str | None = None,
    ) -> Profile:
        """Cell-wise mean over all operands, absent cells counting as 0."""
        return _stored(algebra.mean(*profiles, system_dim=system_dim), output_dir)

    def cmp(self, other: Profile, rel_tol: float = 0.0) -> algebra.CompareResult:
        """Compare dimensions and values with ``other``."""
        return algebra.cmp(self, other, rel_tol=rel_tol)


def _stored(result: Profile, output_dir: str | None) -> Profile:
    return result if output_dir is None else result.write(output_dir)
