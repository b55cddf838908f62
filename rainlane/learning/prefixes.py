"""Grid search over the size and depth of an ensemble without a fit for each.

A boosted ensemble of 100 rounds begins with the one of 50 rounds, so settings that differ in
the number of rounds only need one fit, and each is evaluated on its first trees. So with
forests, whose settings of 50 and 100 trees are then parts of the forest of 150 trees, where
separate fits would draw other rows for the same trees.

A limit on the depth that no tree reaches changes no tree. Of settings that differ in size and depth
alone the deepest is fitted first; those whose depth none of its trees reaches take its trees, and
only the others are fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import Future
from threading import Lock

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame

#: The parameter that says how many trees an ensemble has.
SIZES = ("maxIter", "numTrees")
DEPTH = "maxDepth"


def first_trees(model, n: int):
    """The ensemble of the first ``n`` trees of a fitted forest or boosted ensemble."""
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression

    def first(values, kind):
        part = gateway.new_array(kind, n)
        for k in range(n):
            part[k] = values[k]
        return part

    trees = first(java.trees(), regression.DecisionTreeRegressionModel)
    # A copy, as a new wrapper asks Java about each tree, which takes as long as a small fit.
    part = model.copy()
    part.__dict__.pop("trees", None)
    if isinstance(model, GBTRegressionModel):
        weights = first(java.treeWeights(), gateway.jvm.double)
        part._java_obj = regression.GBTRegressionModel(java.uid(), trees, weights, java.numFeatures())
    else:
        part._java_obj = regression.RandomForestRegressionModel(java.uid(), trees, java.numFeatures())
    return part._set(**{"maxIter" if isinstance(model, GBTRegressionModel) else "numTrees": n})


def reaches(model, depth: int) -> bool:
    """Whether a tree of the ensemble is so deep that ``depth`` as its limit may have cut it."""
    return any(tree.depth() >= depth for tree in model._java_obj.trees())


class PrefixPipeline(Pipeline):
    """A pipeline that ends in an ensemble of trees, fitted once for all param maps that differ
    in the number of trees alone, or in depths beyond that of its trees."""

    def fitMultiple(self, dataset: DataFrame, paramMaps) -> Iterator[tuple[int, PipelineModel]]:
        return _Fits(self.copy(), dataset, paramMaps)


class _Fits:
    """Index and model of each param map, the deepest and largest ensemble of each group first, so
    that threads that ask side by side fit different groups."""

    def __init__(self, pipeline: Pipeline, dataset: DataFrame, maps):
        self.pipeline, self.dataset, self.maps = pipeline, dataset, maps
        groups: dict[tuple, dict[int, list[tuple[int, int]]]] = {}
        for index, one in enumerate(maps):
            size = next((v for p, v in one.items() if p.name in SIZES), 0)
            depth = next((v for p, v in one.items() if p.name == DEPTH), 0)
            rest = tuple(sorted((p.name, v) for p, v in one.items() if p.name not in (*SIZES, DEPTH)))
            groups.setdefault(rest, {}).setdefault(depth, []).append((size, index))
        # Of each depth the largest ensemble, and of each group the deepest of these.
        self.largest: dict[int, int] = {}
        self.deepest: dict[int, int] = {}
        self.fitted: dict[int, Future] = {}
        order: list[list[tuple[int, int, int]]] = [[], [], []]
        for by_depth in groups.values():
            deepest = max(by_depth[max(by_depth)])
            for depth, own in by_depth.items():
                first, *others = sorted(own, reverse=True)
                self.largest |= {index: first[1] for _, index in own}
                self.fitted[first[1]] = Future()
                # More trees than the deepest has can't be taken from it.
                self.deepest[first[1]] = deepest[1] if first[0] <= deepest[0] else first[1]
                order[first != deepest].append((*first, depth))
                order[2] += [(*one, depth) for one in others]
        self.left, self.lock = iter(sum(order, [])), Lock()

    def __iter__(self) -> _Fits:
        return self

    def __next__(self) -> tuple[int, PipelineModel]:
        with self.lock:
            size, index, depth = next(self.left)
        largest = self.fitted[self.largest[index]]
        if self.largest[index] == index:
            try:
                largest.set_result(self._of_depth(index, size, depth))
            except BaseException as error:
                largest.set_exception(error)
            return index, largest.result()
        *before, ensemble = largest.result().stages
        return index, PipelineModel([*before, _limited(first_trees(ensemble, size), depth)])

    def _of_depth(self, index: int, size: int, depth: int) -> PipelineModel:
        if self.deepest[index] != index:
            *before, ensemble = self.fitted[self.deepest[index]].result().stages
            if not reaches(ensemble, depth):
                return PipelineModel([*before, _limited(first_trees(ensemble, size), depth)])
        return self.pipeline.fit(self.dataset, self.maps[index])


def _limited(model, depth: int):
    """The model with the limit it is for, if the grid has one."""
    return model._set(**{DEPTH: depth}) if depth else model
