"""Nested group trees: cache files, and the walk against a plain recursion."""

import json
import random

from tellake.sources import trees


def plain(tree, path=()):
    here = [*path, tree.get("name")]
    out = [(r, here, tree.get("id")) for r in tree.get("replays") or []]
    for child in tree.get("children") or []:
        out += plain(child, here)
    return out


def grown(rng, depth, number):
    number[0] += 1
    mine = number[0]
    tree = {"id": f"g{mine}", "name": f"name {mine % 5}", "children": [grown(rng, depth - 1, number) for _ in range(rng.randrange(0, 4) if depth else 0)]}
    if rng.random() < 0.7:
        tree["replays"] = [{"id": f"r{mine}-{k}", "title": None if k % 2 else "t"} for k in range(rng.randrange(0, 13))]
    return tree


def check(leaves, tree_id, tree):
    got = sorted((r.place, json.loads(r.replay), r.path, r.group_id) for r in leaves.filter(f"tree_id = '{tree_id}'").collect())
    assert got == [(k, *row) for k, row in enumerate(plain(tree))]


def test_walk_of_any_depth(spark):
    rng = random.Random(4)
    many = {f"t{k}": grown(rng, 5, [0]) for k in range(4)}
    chain = {"id": "x", "name": "x", "replays": [{"id": "top"}]}
    for k in range(25):
        chain = {"id": f"c{k}", "name": f"c{k}", "children": [chain, {"id": f"s{k}", "name": None, "replays": [{"id": f"s{k}r"}]}], "replays": [{"id": f"c{k}r"}]}
    many["chain"], many["bare"] = chain, {"id": "b", "name": "b", "children": None}
    df = spark.createDataFrame([*((k, json.dumps(v)) for k, v in many.items()), ("broken", "{"), ("none", None)], "tree_id string, tree string")
    nodes, leaves = trees.walk(df)
    for k, v in many.items():
        check(leaves, k, v)
    assert {r.tree_id for r in nodes.collect()} == set(many)
    deep = nodes.filter("tree_id = 'chain' AND id = 'x'").first()
    assert deep.at == [0] * 25 and deep.parent_id == "c0" and deep.path == [*[f"c{k}" for k in reversed(range(25))], "x"]
    assert nodes.filter("tree_id = 'bare'").first().parent_id is None and trees.walk(df.limit(0))[1].count() == 0


def test_cache(spark, tmp_path):
    folder = f"file://{tmp_path}/cache"
    tree = grown(random.Random(1), 3, [0])
    assert trees.load_tree(spark, "g", folder) is None and not trees.delete_tree(spark, "g", folder) and trees.read_trees(spark, folder).count() == 0
    for version in ({"id": "old"}, tree):
        assert trees.save_tree(spark, version, "g", folder) == f"{folder}/group_tree_g.json"
    trees.save_tree(spark, {"id": "é", "name": "é", "replays": [{"id": "1"}]}, "h_2", folder)
    assert json.loads((tmp_path / "cache" / "group_tree_g.json").read_text()) == tree and "\n  " in (tmp_path / "cache" / "group_tree_g.json").read_text()
    assert trees.load_tree(spark, "g", folder) == tree
    _, leaves = trees.walk(trees.read_trees(spark, folder))
    check(leaves, "g", tree)
    assert leaves.filter("tree_id = 'h_2'").first().path == ["é"]
    assert trees.delete_tree(spark, "g", folder) and trees.load_tree(spark, "g", folder) is None and trees.read_trees(spark, folder).count() == 1
