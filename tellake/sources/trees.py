"""Nested group trees: cached as JSON files, and as tables of nodes and leaves in the order of a walk."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.storage import exists, remove, stored, write_text


def tree_path(folder: str, group_id: str) -> str:
    return f"{folder.rstrip('/')}/group_tree_{group_id}.json"


def save_tree(spark: SparkSession, tree: dict, group_id: str, folder: str) -> str:
    """Cache one tree {id, name, children, replays} as indented JSON; returns its path.  An earlier one is replaced."""
    write_text(spark, tree_path(folder, group_id), json.dumps(tree, indent=2))
    return tree_path(folder, group_id)


def load_tree(spark: SparkSession, group_id: str, folder: str) -> dict | None:
    """A cached tree, or None where there is none."""
    path = tree_path(folder, group_id)
    return json.loads(spark.read.text(path, wholetext=True).first()[0]) if exists(spark, path) else None


def delete_tree(spark: SparkSession, group_id: str, folder: str) -> bool:
    """Delete a cached tree; whether there was one."""
    return bool(remove(spark, tree_path(folder, group_id)))


def read_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (tree_id, tree) of all cached trees as JSON text; no folder gives no rows."""
    try:
        df = spark.read.options(pathGlobFilter="group_tree_*.json").text(folder, wholetext=True)
    except AnalysisException:
        return spark.createDataFrame([], "tree_id string, tree string")
    return df.select(F.regexp_extract(F.col("_metadata.file_name"), r"^group_tree_(.*)\.json$", 1).alias("tree_id"), F.col("value").alias("tree"))


def walk(trees: DataFrame, tree_id: str = "tree_id", tree: str = "tree") -> tuple[DataFrame, DataFrame]:
    """(nodes, leaves) of nested trees (JSON text) of any depth.

    nodes: rows (tree_id, at, id, parent_id, name, path); leaves: rows (tree_id, place, replay, path, group_id).  at and place
    follow a walk that takes a node's replays first and then its children: at is the way from the root, an array
    of child numbers; place counts the leaves of a tree from 0.  path holds the names from the root to the
    node, or to the leaf's own group; replay is the leaf's JSON.  Broken JSON gives no rows; missing lists are empty.
    One step a level; each is stored, so that a deep tree is not one plan of all its levels.
    """
    root = F.try_parse_json(F.col(tree))
    level = trees.select(F.col(tree_id).alias("tree_id"), root.alias("v")).filter("v is not null").select(
        "tree_id", F.array().cast("array<int>").alias("at"), F.lit(None).cast("string").alias("parent_id"), F.array().cast("array<string>").alias("over"), "v")
    nodes = leaves = None
    while True:
        level = stored(level.select("tree_id", "at", F.try_variant_get("v", "$.id", "string").alias("id"), "parent_id", F.array_append("over", F.try_variant_get("v", "$.name", "string")).alias("path"),
                                    F.try_variant_get("v", "$.replays", "array<variant>").alias("replays"), F.try_variant_get("v", "$.children", "array<variant>").alias("children")))
        if nodes is not None and level.isEmpty():
            break
        here = level.select("tree_id", "at", "id", "parent_id", F.element_at("path", -1).alias("name"), "path")
        own = level.select("tree_id", "at", F.posexplode("replays").alias("k", "replay"), "path", F.col("id").alias("group_id"))
        own = own.select("tree_id", F.concat("at", F.array(F.lit(-1), F.col("k"))).alias("at"), F.to_json("replay").alias("replay"), "path", "group_id")
        nodes, leaves = (here, own) if nodes is None else (nodes.unionByName(here), leaves.unionByName(own))
        below = level.select("tree_id", "at", F.col("id").alias("parent_id"), F.col("path").alias("over"), F.posexplode("children").alias("k", "v"))
        level = below.select("tree_id", F.array_append("at", F.col("k")).alias("at"), "parent_id", "over", "v")
    place = F.row_number().over(Window.partitionBy("tree_id").orderBy("at")) - 1
    return nodes, leaves.select("tree_id", place.cast("long").alias("place"), "replay", "path", "group_id")
