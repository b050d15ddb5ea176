"""Weighted ranking of linked lists too long for one task.

``ranked`` gives each element the sums of the weights from it to the end of its list. Three steps, each a
relation "sum of an element = its own weights + the sum of another element":

1. Blocks: elements that lie together are contracted in one task each; a chain inside a block becomes its
   head. The caller's ``block`` column should keep neighbours together and blocks small.
2. Rounds: each element draws a coin by hash. One with tails whose predecessor has heads is spliced out, so
   about a quarter goes, by a join on the link; all rounds together cost a few times the first.
3. What is left, ``final`` elements at most, is ranked in one task, and the rounds are undone in reverse.

Lists end with a null link. Cycles are not lists: ``ranked`` raises when elements do not get fewer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import written

FINAL = 50_000
MAX_ROUNDS = 200
_NONE = -1


def chains(item: np.ndarray, link: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each item: its sums to the end of its chain here, the link that leaves it, and whether it is a head.

    ``link`` is -1 at the end of a list. Pointers double until all have reached their chain's end.
    """
    order = np.argsort(item)
    at = np.searchsorted(item[order], link)
    at[at == len(item)] = 0
    to = order[at]
    to = np.where(item[to] == link, to, _NONE)
    head = np.ones(len(item), bool)
    head[to[to >= 0]] = False
    sums, last = weights.copy(), np.arange(len(item))
    for _ in range(len(item).bit_length() + 1):
        going = np.flatnonzero(to >= 0)
        if not len(going):
            return sums, link[last], head
        ahead = to[going]
        sums[:, going] += sums[:, ahead]
        last[going], to[going] = last[ahead], to[ahead]
    raise ValueError("the links form a cycle")


def _contracted(names: Sequence[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def contract(rows: pd.DataFrame) -> pd.DataFrame:
        link = rows["next"].fillna(_NONE).to_numpy(np.int64)
        sums, left, head = chains(rows["item"].to_numpy(np.int64), link, rows[list(names)].to_numpy(np.int64).T)
        out = pd.DataFrame({"item": rows["item"], "next": pd.array(left, "Int64"), "head": head})
        out.loc[left == _NONE, "next"] = pd.NA
        return out.assign(**dict(zip(names, sums, strict=True)))

    return contract


def _coin(item: str, turn: int):
    return F.pmod(F.xxhash64(F.lit(turn), F.col(item)), F.lit(2)) == 1


def _followed(rows: DataFrame, known: DataFrame, names: Sequence[str]) -> DataFrame:
    """item and sums of rows (item, next, weights) whose ``next`` is known, or null."""
    ahead = known.select(F.col("item").alias("_ahead"), *[F.col(n).alias(f"_{n}") for n in names])
    sums = [(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names]
    return rows.join(ahead, F.col("next") == F.col("_ahead"), "left").select("item", *sums)


def ranked(links: DataFrame, names: Sequence[str], final: int = FINAL) -> DataFrame:
    """item and, for each of the named weights, its sum from the item to the end of its list.

    ``links``: item and next (long; null at an end), block (int), and the weights (long).
    """
    names = list(names)
    longs = ", ".join(f"{n} long" for n in names)
    contract = _contracted(names)
    first = written(links.groupBy("block").applyInPandas(contract, f"item long, next long, head boolean, {longs}"), "list-blocks")
    rest, size, spliced = first.filter("head").drop("head"), first.filter("head").count(), []
    while size > final:
        if len(spliced) == MAX_ROUNDS:
            raise RuntimeError(f"the links did not settle in {MAX_ROUNDS} rounds")
        one = rest.filter(~_coin("item", len(spliced)))
        two = rest.filter(_coin("item", len(spliced))).select(*[F.col(c).alias(f"_{c}") for c in ("item", "next", *names)])
        met = written(one.join(two, F.col("next") == F.col("_item"), "full"), "list-round")
        both = F.col("item").isNotNull() & F.col("_item").isNotNull()
        merged = [F.when(both, F.col(n) + F.col(f"_{n}")).otherwise(F.coalesce(n, f"_{n}")).alias(n) for n in names]
        link = F.when(both | F.col("item").isNull(), F.col("_next")).otherwise(F.col("next")).alias("next")
        rest = met.select(F.coalesce("item", "_item").alias("item"), link, *merged)
        spliced.append(met.filter(both).select(*[F.col(f"_{c}").alias(c) for c in ("item", "next", *names)]))
        size = met.count()
    # At most ``final`` elements.
    whole = rest.withColumn("block", F.lit(0)).groupBy("block").applyInPandas(contract, f"item long, next long, head boolean, {longs}")
    known = written(whole.select("item", *names), "list-known")
    for gone in reversed(spliced):
        known = written(known.unionByName(_followed(gone, known, names)), "list-known")
    return known.unionByName(_followed(first.filter("not head").drop("head"), known, names))
