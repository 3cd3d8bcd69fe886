"""Parents, children and the documents that nest one in the other."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .ordinals import occurrence

# --- fixed value: entries of one connection that a document carries ---------
CONNECTION_SIZE = 250
# --- end of fixed values ----------------------------------------------------
# Owners that may be split, and keys that the sketch of heavy owners tracks.
HOT_OWNERS = 1024
TRACKED_OWNERS = 1 << 16
# Children of a slice of a heavy owner, about.
SLICE_ROWS = 1 << 20
# Children of an owner that are listed at once, about; the ordinals of more are counted by blocks.
# Lists are sorted by `sort_array`, whose order of structs is that of `array_sort`; that one
# interprets its comparison for every pair.
LISTED_ROWS = 1 << 14


def distinct_keys(df: DataFrame, key: str = "id", name: str = "__key") -> DataFrame:
    """Distinct keys for the right side of a semi or anti join.

    Copies are dropped before and in a shuffle of the bare keys, so copies of one
    key do not gather in the join.  The second column keeps that shuffle apart
    from the join's own: only a side that comes straight from a shuffle lets
    adaptive execution split a hot key on the other side.
    """
    keys = df.select(F.col(key).alias(name))
    return keys.withColumn("__apart", F.xxhash64(name)).distinct().select(name)


def attach_parent(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    prefix: str = "parent_",
    key: str = "id",
    orphans_too: bool = True,
) -> DataFrame:
    """Children with columns of their parent, null for a child whose parent is missing;
    without `orphans_too` such children are left out.

    The parent is unique by key and the child side is the large one, so a hot
    parent only lengthens child partitions; adaptive execution splits those.
    """
    renamed = parent.select(F.col(key).alias("__key"), *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    how = "left" if orphans_too else "inner"
    return child.join(renamed, child["parent_id"] == renamed["__key"], how).drop("__key")


def orphans(child: DataFrame, parent: DataFrame, key: str = "id", link: str = "parent_id") -> DataFrame:
    """Children whose parent is missing.  Rows without a link are not children."""
    keys = distinct_keys(parent, key)
    linked = child.where(F.col(link).isNotNull())
    return linked.join(keys, linked[link] == keys["__key"], "left_anti")


def heavy_owners(child: DataFrame, link: str, slice_rows: int | None = None) -> dict:
    """The heaviest owners, `HOT_OWNERS` at most, and into how many slices of about
    `slice_rows` children each is to be cut.  One pass over the links; tasks sketch their
    own, so a heavy owner costs no task more than another.  What the sketch estimates
    decides only how the work is dealt."""
    return heavy_links(child, link, SLICE_ROWS if slice_rows is None else slice_rows)[0]


def heavy_links(child: DataFrame, link: str, rows: int) -> tuple[dict, bool]:
    """`heavy_owners`, and whether there are children without a link."""
    top = F.expr(f"approx_top_k(`{link}`, {HOT_OWNERS}, {TRACKED_OWNERS})").alias("top")
    found = child.agg(top, F.count_if(F.col(link).isNull()).alias("loose")).first()
    counts = {r["item"]: r["count"] for r in found["top"] or [] if r["item"] is not None}
    return {item: -(-n // rows) for item, n in counts.items() if n > rows}, found["loose"] > 0


def with_children(
    parent: DataFrame,
    child: DataFrame,
    n: int,
    order: Sequence[Column | str],
    fields: Sequence[str],
    link: str = "parent_id",
    name: str = "children",
    key: str = "id",
) -> DataFrame:
    """Every parent with its first n children nested as a list.

    The first n are taken in two steps, of each slice of an owner's children and then of
    all.  A sketch of the links finds heavy owners and how many slices each needs, so a
    slice stays small however many children an owner has; other owners have one.  The
    limit of n also runs before each shuffle, and no list exceeds n.
    """
    slices = heavy_owners(child, link)
    of_owner = F.lit(1)
    if slices:
        kind = child.schema[link].dataType
        known = F.create_map(*[F.lit(x).cast(t) for pair in slices.items() for x, t in zip(pair, (kind, "int"))])
        of_owner = F.coalesce(known[F.col(link)], F.lit(1))
    sliced = child.withColumn("__slice", F.spark_partition_id() % of_owner)
    first = F.row_number().over(Window.partitionBy(link, "__slice").orderBy(*order))
    few = sliced.withColumn("__ordinal", first).where(F.col("__ordinal") <= n)
    ordinal = F.row_number().over(Window.partitionBy(link).orderBy(*order))
    few = few.withColumn("__ordinal", ordinal).where(F.col("__ordinal") <= n)
    lists = few.groupBy(F.col(link).alias("__link")).agg(
        F.sort_array(F.collect_list(F.struct("__ordinal", F.struct(*fields).alias("value")))).alias("__sorted")
    )
    lists = lists.select("__link", F.transform("__sorted", lambda e: e["value"]).alias(name))
    return parent.join(lists, parent[key] == lists["__link"], "left").drop("__link")


def connection_documents(
    child: DataFrame,
    link: str,
    order: Sequence[str],
    node: Column | None,
    block: Column,
    size: int = CONNECTION_SIZE,
) -> DataFrame:
    """Nest children as connections of at most `size` edges per document.

    Gives (link, part, offset, edges): a parent with more children has several
    parts, so no row and no group grows with a hot parent.  Without `node` an entry is
    the child's row, less its link; so rows can stay narrow until they are written out.

    A sketch of the links finds heavy owners.  The children of others move once, to be
    listed and cut; those of heavy owners, and children without a link, are numbered
    by blocks, so that one owner's spread over many tasks.
    """
    heavy, loose = heavy_links(child, link, LISTED_ROWS)
    if node is None:
        node = F.struct(*order, *[c for c in child.columns if c not in (link, *order)])
        entry = F.struct(node.alias("node")).alias("__entry")
    else:
        entry = F.struct(*order, node.alias("node")).alias("__entry")
    apart = F.coalesce(F.col(link).isin(list(heavy)), F.lit(True)) if heavy else F.col(link).isNull()
    light = child.where(~apart) if heavy or loose else child
    lists = listed_documents(light, link, entry, size)
    if heavy or loose:
        lists = lists.unionAll(blocked_documents(child.where(apart), link, order, entry, block, size))
    return edges_of(lists, size, link)


def edges_of(lists: DataFrame, size: int, *keys: str) -> DataFrame:
    """(keys, part, offset, edges) of lists cut into parts."""
    edges = F.transform("__entries", lambda e: F.struct(e["node"].alias("node"))).alias("edges")
    return lists.select(*keys, "part", (F.col("part") * size).cast("bigint").alias("offset"), edges)


def listed_documents(child: DataFrame, link: str, entry: Column, size: int, *also: str) -> DataFrame:
    """(link, part, __entries) of owners whose children fit one list; `also` are columns
    that the link decides."""
    lists = child.groupBy(*also, link).agg(F.sort_array(F.collect_list(entry)).alias("__all"))
    last = F.expr(f"(array_size(__all) - 1) div {size}")
    parts = F.transform(
        F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")),
        lambda i: F.struct(i.alias("part"), F.slice("__all", (i * size + 1).cast("int"), F.lit(size)).alias("__entries")),
    )
    return lists.select(*also, link, F.inline(parts))


def blocked_documents(
    child: DataFrame, link: str, order: Sequence[str], entry: Column, block: Column, size: int
) -> DataFrame:
    """The same of owners with any number of children, null among them."""
    numbered = occurrence(child, [link], order, block, name="__ordinal")
    parts = numbered.select(
        link,
        F.expr(f"(__ordinal - 1) div {size}").cast("bigint").alias("part"),
        F.struct("__ordinal", entry).alias("__numbered"),
    )
    lists = parts.groupBy(link, "part").agg(F.sort_array(F.collect_list("__numbered")).alias("__sorted"))
    return lists.select(link, "part", F.transform("__sorted", lambda e: e["__entry"]).alias("__entries"))


def nest_connections(parent: DataFrame, connections: DataFrame, key: str, link: str) -> DataFrame:
    """Parents with the parts of their connection, one row per part; a parent
    without any keeps one row.

    This is a left join, written as an inner join and the rest: a parent with
    very many parts makes the right side heavy, and adaptive execution can split
    that side of an inner join only.  Both read the same parents, those with a key, so
    that these are shuffled once.
    """
    known = parent.where(F.col(key).isNotNull())
    with_parts = known.join(connections, known[key] == connections[link]).drop(link)
    owners = connections.select(F.col(link).alias("__key")).distinct()
    without = known.join(owners, known[key] == owners["__key"], "left_anti")
    unknown = parent.where(F.col(key).isNull())
    return with_parts.unionByName(without, allowMissingColumns=True).unionByName(unknown, allowMissingColumns=True)


def nest_by_page(
    parent: DataFrame,
    rows: DataFrame,
    key: str,
    link: str,
    order: Sequence[str],
    block: Column,
    page_size: int,
    shape: Callable[..., DataFrame] = lambda rows, *also: rows,
    size: int = CONNECTION_SIZE,
) -> list[DataFrame]:
    """`nest_connections` with the `connection_documents` of `shape(rows)`, for documents
    that go on pages of `page_size` keys, `page`.  `shape` may aggregate the rows; it groups
    by the columns that it is given, too.

    Rows and parents are dealt by their page, once: what is done with them per pair, per
    owner and per page then needs no shuffle.  So the join is one of pages, and the key is
    compared within a page.  Heavy owners, found by a sketch of the bare rows, are in a
    frame of their own and spread over many tasks.
    """
    heavy, _ = heavy_links(rows, link, LISTED_ROWS)
    page, number = f"{link}_page", f"`{{}}` div {page_size}"
    parent = parent.withColumn("page", F.expr(number.format(key)))
    linked = rows.where(F.col(link).isNotNull())
    light, owners = linked, parent
    if heavy:
        light = linked.where(~F.col(link).isin(list(heavy)))
        owners = parent.where(F.coalesce(~F.col(key).isin(list(heavy)), F.lit(True)))
    child = shape(light.withColumn(page, F.expr(number.format(link))).repartition(page), page)
    node = F.struct(*order, *[c for c in child.columns if c not in (page, link, *order)])
    lists = edges_of(listed_documents(child, link, F.struct(node.alias("node")).alias("__entry"), size, page), size, page, link)
    # Equal, but no key of the join.
    same = owners[key].between(lists[link], lists[link])
    frames = [owners.join(lists, (owners["page"] == lists[page]) & same, "left").drop(page, link)]
    if heavy:
        apart = connection_documents(shape(linked.where(F.col(link).isin(list(heavy)))), link, order, None, block, size)
        frames.append(nest_connections(parent.where(F.col(key).isin(list(heavy))), apart, key, link))
    return frames


def linked_to(mixed: DataFrame, roots: DataFrame, depth: int, link: str = "__parentId", stored: bool = False) -> DataFrame:
    """The given root rows of a mixed frame and everything linked below them.

    A row is kept when its owner is: its parent for linked rows, itself for a
    root.  The ids of the owners are gathered level by level from two narrow
    columns and made distinct before they are shuffled, so whole rows move once,
    whatever the depth.

    Of a `stored` frame, which is cheap to read again, root rows stay where they are and only
    linked rows move.  That holds if no row without a link has the id of an owner but the
    roots, which is counted first, from bare ids.
    """
    level = distinct_keys(roots)
    keys = level
    links = mixed.where(F.col(link).isNotNull()).select("id", F.col(link).alias("__link"))
    for _ in range(depth - 1):
        below = links.join(level, links["__link"] == level["__key"], "left_semi")
        level = distinct_keys(below)
        keys = keys.unionAll(level)
    if stored:
        own, unlinked = mixed.where(F.col(link).isNull()).select("id"), roots.where(F.col(link).isNull())
        if own.join(keys, own["id"] == keys["__key"], "left_semi").count() == unlinked.count():
            rows = mixed.where(F.col(link).isNotNull())
            linked = rows.join(keys, rows[link] == keys["__key"], "left_semi")
            return unlinked.select(*mixed.columns).unionAll(linked)
    owned = mixed.withColumn("__owner", F.coalesce(link, "id"))
    return owned.join(keys, owned["__owner"] == keys["__key"], "left_semi").drop("__owner")
