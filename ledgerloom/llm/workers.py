"""Array code that runs inside Spark tasks; shipped by value, so executors need not have this package."""

from __future__ import annotations

import sys
import types

import numpy as np
from pyspark import cloudpickle


def by_value(module_name: str) -> None:
    """Send functions of a module with the plan instead of importing the module on executors."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def kept_in_worker(key, build):
    """What build() gives, kept in the Python worker for its later tasks; the last two keys at most.

    For tables made from vocabularies, whose size does not depend on the data, and memos with a bound of their own. Code sent by value has no module of its own
    that outlives a task, so they are kept in one that is made here.
    """
    name = "_kept_between_tasks"
    kept = sys.modules.setdefault(name, types.ModuleType(name)).__dict__.setdefault("kept", {})
    if key not in kept:
        while len(kept) > 1:
            del kept[next(iter(kept))]
        kept[key] = build()
    return kept[key]


def whole_runs(batches, key: str):
    """Record batches sorted by a column, as tables that never end inside a run of equal keys."""
    import pyarrow as pa

    kept = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        start = int(np.searchsorted(keys, keys[-1], side="left"))
        if start == 0 and kept and kept[-1].column(key)[-1].as_py() == keys[0]:
            kept.append(batch)  # still the same run
            continue
        kept.append(batch.slice(0, start))
        done = [b for b in kept if b.num_rows]
        if done:
            yield pa.Table.from_batches(done)
        kept = [batch.slice(start)]
    if kept:
        yield pa.Table.from_batches(kept)


def later_in_run(ends: np.ndarray, heads: np.ndarray, most: int = 2_000_000):
    """Index pairs (i, j): i in heads, j after i in i's run (ends[i] is the run's end); some millions at a time."""
    counts = ends[heads] - heads - 1
    total = np.cumsum(counts)
    at = 0
    while at < len(heads):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
        each, n = counts[at:to], int(total[to - 1] - before)
        left = np.repeat(heads[at:to], each)
        offset = np.arange(n) - np.repeat(np.cumsum(each) - each, each)
        yield left, left + 1 + offset
        at = to


def run_ends(keys: np.ndarray) -> np.ndarray:
    """For each row of sorted keys, the index after the last row with its key."""
    change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    bounds = np.concatenate(([0], change, [len(keys)]))
    return np.repeat(bounds[1:], np.diff(bounds))


def spanning_links(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: each node with the smallest node that it reaches."""
    nodes, ends = np.unique(np.concatenate((left, right)), return_inverse=True)
    a, b = ends[: len(left)], ends[len(left) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    tied = label != np.arange(len(nodes))
    return nodes[tied], nodes[label[tied]]


by_value(__name__)
