"""Storage paths, names and sizes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed value: characters that no path part may hold
FORBIDDEN = '<>:"/\\|?*'
SIDECAR = ".metadata.json"


def sanitize(part: Column) -> Column:
    """Forbidden characters to _, then dots and spaces stripped from both ends."""
    return F.btrim(F.translate(part, FORBIDDEN, "_" * len(FORBIDDEN)), F.lit(". "))


def build_path(parts: Column, root: Column, include_root: Column | bool = False) -> Column:
    """Sanitised parts; the first is dropped if roots are excluded and it equals the sanitised root."""
    clean = F.transform(parts, sanitize)
    keep = F.lit(include_root) if isinstance(include_root, bool) else include_root
    return F.when(~keep & (F.get(clean, F.lit(0)) == sanitize(root)), F.slice(clean, F.lit(2), F.greatest(F.size(clean) - 1, F.lit(0)))).otherwise(clean)


def format_bytes(n: Column) -> Column:
    """1023 B, 4.77 MB, ...: two decimals from KB on, a half to the even digit as C and Python print it; NULL stays NULL.

    Division by a power of two is exact in a double, so halves are true halves; format_string alone would round them up.
    """
    out = F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B")))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB")):
        x = n / float(1024**power)
        whole = F.floor(x)
        text = F.format_string(f"%.2f {unit}", whole + F.bround(x - whole, 2))
        out = out.when(n < 1024 ** (power + 1) if power < 3 else n.isNotNull(), text)
    return out


def storage_key(components: Column, key: Column, extension: str = ".replay") -> Column:
    """components/.../key.replay, without a leading slash if there are none."""
    return F.concat(F.when(F.size(components) > 0, F.concat(F.array_join(components, "/"), F.lit("/"))).otherwise(F.lit("")), key, F.lit(extension))


def mirror_key(raw: Column, key: Column, extension: str = ".parquet") -> Column:
    """Key of a parsed file beside its raw one; flat by id where there is no raw key.  Side tables have SIDECAR as extension."""
    inner = F.when(raw.startswith("replays/raw/"), F.substr(raw, F.lit(13))).otherwise(raw)
    return F.concat(F.lit("replays/parsed/"), F.when(raw.isNull(), key).otherwise(F.replace(inner, F.lit(".replay"), F.lit(""))), F.lit(extension))


def plain(path: Column) -> Column:
    """One spelling of local paths: file:/a, file:///a and /a are the same file; other schemes stay."""
    return F.regexp_replace(path, "^file:/+", "/")


def below(root: str, path: Column) -> Column:
    """path below root; an absolute path or one with a scheme stays as it is."""
    return F.when(path.rlike("^(/|[A-Za-z][A-Za-z0-9+.-]*:/)"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def resolve(wanted: DataFrame, listing: DataFrame, key: str, candidates: list[Column], path: str = "path") -> DataFrame:
    """Rows (key, path): the first candidate that the listing has; keys without one are dropped."""
    return locate(wanted, listing, key, candidates, path=path).filter("path is not null").select(key, "path")


def locate(wanted: DataFrame, listing: DataFrame, key: str, candidates: list[Column], anywhere: Column | None = None, otherwise: Column | None = None, path: str = "path") -> DataFrame:
    """Rows (key, path, rule), one a row of wanted: where its file is, and by which rule it was found.

    Rules in order: the candidates (rule 0, 1, ...; NULL ones are passed over) that the listing has; then any
    listed file of the name `anywhere`, whatever its folder (rule `anywhere`; the first path of equal names);
    then `otherwise`, unchecked, such as an address in a store that is not listed (rule `otherwise`).  A miss has
    NULL path and rule.  Two equi-joins with the listing, indexed by path and by name; one row a path and name,
    so equal names do not multiply rows.  Rows of wanted with equal keys are the same file; keys are not NULL.
    """
    listed = listing.select(plain(F.col(path)).alias("__path")).filter("__path is not null").distinct()
    tries = [F.struct(F.lit(k).alias("rank"), plain(c).alias("try")) for k, c in enumerate(candidates)]
    name, last = (F.lit(None).cast("string") if c is None else c for c in (anywhere, otherwise))
    asked = wanted.select(F.col(key), F.array(*tries).alias("__tries"), name.alias("__name"), last.alias("__last")).dropDuplicates([key])
    each = asked.select(key, F.explode("__tries").alias("t")).filter("t.try is not null").select(key, "t.rank", F.col("t.try").alias("__path"))
    exact = each.join(listed, "__path").groupBy(key).agg(F.min(F.struct("rank", "__path")).alias("__exact"))
    out = asked.join(exact, key, "left")
    if anywhere is not None:
        names = listed.groupBy(file_name(F.col("__path")).alias("__name")).agg(F.min("__path").alias("__any"))
        out = out.join(names, "__name", "left")
    else:
        out = out.withColumn("__any", F.lit(None).cast("string"))
    rule = F.when(F.col("__exact").isNotNull(), F.col("__exact.rank").cast("string")).when(F.col("__any").isNotNull(), "anywhere").when(F.col("__last").isNotNull(), "otherwise")
    return out.select(key, F.coalesce("__exact.__path", "__any", "__last").alias("path"), rule.alias("rule"))


def dataset_candidates(key: Column, output: Column, data_dir: str | None = None, cache_dir: str | None = None) -> list[Column]:
    """A parsed file for loading: the cache, an absolute path on record, else that path and then its name below data_dir."""
    absolute = output.startswith("/")
    out = [] if cache_dir is None else [F.concat(F.lit(cache_dir.rstrip("/") + "/"), key, F.lit(".parquet"))]
    out.append(F.when(absolute, output))
    return out if data_dir is None else [*out, F.when(~absolute, below(data_dir, output)), F.when(~absolute, below(data_dir, file_name(output)))]


def raw_candidates(key: Column, stored_at: Column, root: str) -> list[Column]:
    """A raw file: its storage key, then key.replay, below root; locate() then looks for key.replay in any folder."""
    return [below(root, F.nullif(stored_at, F.lit(""))), below(root, F.concat(key, F.lit(".replay")))]


def backfill_candidates(key: Column, output: Column, data_dir: str | None = None) -> list[Column]:
    """A parsed file for the backfill: an absolute path on record, then that path, its name and key.parquet below data_dir."""
    out = [F.when(output.startswith("/"), output)]
    return out if data_dir is None else [*out, below(data_dir, output), below(data_dir, file_name(output)), below(data_dir, F.concat(key, F.lit(".parquet")))]


def store_address(bucket: str, output: Column) -> Column:
    """Address of a stored path in an object store, the last resort of the loading and backfill rules."""
    return F.concat(F.lit(f"s3://{bucket}/"), output)


def locate_parsed(wanted: DataFrame, listing: DataFrame, key: str, output: str, data_dir: str | None = None, cache_dir: str | None = None, bucket: str | None = None) -> DataFrame:
    """locate() by the loading rules."""
    k, o = F.col(key).cast("string"), F.col(output)
    return locate(wanted, listing, key, dataset_candidates(k, o, data_dir, cache_dir), otherwise=None if bucket is None else store_address(bucket, o))


def locate_raw(wanted: DataFrame, listing: DataFrame, key: str, stored_at: str, root: str) -> DataFrame:
    """locate() by the rules for raw files; listing is of root and all folders below."""
    k = F.col(key).cast("string")
    return locate(wanted, listing, key, raw_candidates(k, F.col(stored_at), root), anywhere=F.concat(k, F.lit(".replay")))


def locate_for_backfill(wanted: DataFrame, listing: DataFrame, key: str, output: str, data_dir: str | None = None, bucket: str | None = None) -> DataFrame:
    """locate() by the backfill's rules."""
    k, o = F.col(key).cast("string"), F.col(output)
    return locate(wanted, listing, key, backfill_candidates(k, o, data_dir), otherwise=None if bucket is None else store_address(bucket, o))


def storage_statistics(listing: DataFrame, prefix: str | None = None) -> DataFrame:
    """One row (files, bytes, mb, gb) over a listing (path, length) under a prefix; zeros where there is nothing."""
    some = listing if prefix is None else listing.filter(F.col("path").startswith(prefix))
    total = F.coalesce(F.sum("length"), F.lit(0))
    return some.agg(F.count("*").alias("files"), total.alias("bytes"), F.round(total / float(1024**2), 2).alias("mb"), F.round(total / float(1024**3), 2).alias("gb"))


def tree_paths(groups: DataFrame, leaves: DataFrame) -> DataFrame:
    """Rows (leaf_id, path): names from the root to the leaf's own group.

    groups(id, parent_id, name), leaves(leaf_id, group_id).  One join a level, as deep as the tree;
    a group is not followed into itself.
    """
    level = groups.filter("parent_id is null").select("id", F.array("name").alias("path"), F.array("id").alias("seen"))
    out, children = level, groups.select(F.col("id").alias("child"), "parent_id", "name")
    from ..operators.storage import stored

    while True:
        below = children.join(level, (children.parent_id == level.id) & ~F.array_contains("seen", F.col("child")))
        # each level is cut off from those above, so that a deep tree is not one plan of all its joins
        level = below.select(F.col("child").alias("id"), F.array_append("path", F.col("name")).alias("path"), F.array_append("seen", F.col("child")).alias("seen"))
        level = stored(level)
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return leaves.join(out, leaves.group_id == out.id).select("leaf_id", "path")
