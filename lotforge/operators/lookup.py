"""Foreign-key lookups against clean parents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotforge.model import ROW_IDENTITY, Parent

# Parts that the answers of a route are filed in.
_DRAWERS = 256


def _search(link: Parent) -> str:
    return f"_busca_{link.key}"


def spread(rows: DataFrame, links: tuple[Parent, ...]) -> DataFrame:
    """The keys that `lookup` joins on, as columns, so that no join carries the row identity for it.

    Rows without a foreign key get values of their own that no parent has.
    """
    filler = F.concat(F.lit("\u0000"), F.xxhash64(*ROW_IDENTITY).cast("string"))
    return rows.withColumns({_search(link): F.coalesce(F.col(link.key), filler) for link in links})


def _offered(parent: DataFrame, link: Parent) -> DataFrame:
    """A parent's side of a lookup: one row per key."""
    return parent.select(
        F.col(link.key).alias("_chave"), *link.carries, F.lit(True).alias("_achado")
    ).hint("shuffle_hash")


def lookup(child: DataFrame, parent: DataFrame, link: Parent) -> DataFrame:
    """LEFT join adding the parent's columns and an existence flag; never fans out.

    `parent` holds one row per key. Rows with a NULL key cannot match and would all land in one
    partition, so they join on a spread filler. A frequent real key is split by adaptive skew
    handling, which applies to the left side of a left join. Parents are unique by key, so their
    partitions are even and are hashed; the children are not sorted. The join is the same at every
    size.
    """
    right = _offered(parent, link)
    left = child if _search(link) in child.columns else spread(child, (link,))
    matches = (F.col(_search(link)) == F.col("_chave")) & F.col(link.key).isNotNull()
    return (
        left.join(right, matches, "left")
        .withColumn(link.flag, F.col("_achado").isNotNull())
        .drop("_chave", "_achado", _search(link))
    )


def restrict(child: DataFrame, parent: DataFrame, link: Parent) -> DataFrame:
    """INNER counterpart of `lookup` for callers that only want rows whose parent exists."""
    right = parent.select(link.key, *link.carries).hint("shuffle_hash")
    return child.join(right, link.key, "inner")


# --- lookups by route: narrow questions go to the parents, the rows themselves stay ---------------


def _asks(rows: DataFrame, link: Parent, route: str, *beside: str) -> DataFrame:
    return rows.where(F.col(link.key).isNotNull()).select(route, F.col(link.key).alias(_search(link)), *beside)


def _told(asked: DataFrame, link: Parent, route: str, *columns: str, beside: tuple[str, ...] = ()) -> DataFrame:
    """One row per route with its different answers, brought there in one shuffle.

    They are filed under a hash, so that a route of very many is searched in little.
    """
    drawer = _drawer(_search(link), *beside).alias("_gaveta")
    said = F.collect_set(F.struct(_search(link), *columns)).alias("_ditos")
    drawers = asked.repartition(route).groupBy(route, drawer).agg(said)
    return drawers.groupBy(route).agg(F.collect_list(F.struct("_gaveta", "_ditos")).alias("_gavetas"))


def _drawer(*columns: str) -> Column:
    return F.pmod(F.hash(*columns), F.lit(_DRAWERS))


def _met(rows: DataFrame, told: DataFrame, link: Parent, route: str, beside: tuple[str, ...] = ()) -> DataFrame:
    """Rows with the answer to their question as `_dito`, NULL for none; never fans out.

    The join has the route as its only key, as rows lie by it alone.
    """
    right = told.withColumnRenamed(route, "_r").hint("shuffle_hash")
    drawer = F.get(F.filter("_gavetas", lambda g: g["_gaveta"] == _drawer(link.key, *beside)), F.lit(0))

    def own(said: Column) -> Column:
        return reduce(
            Column.__and__, (said[c].eqNullSafe(F.col(c)) for c in beside), said[_search(link)] == F.col(link.key)
        )

    found = F.get(F.filter(drawer["_ditos"], own), F.lit(0))
    return rows.join(right, F.col(route) == F.col("_r"), "left").withColumn("_dito", found).drop("_r", "_gavetas")


def lookup_by_route(child: DataFrame, asking: DataFrame, parent: DataFrame, link: Parent, route: str) -> DataFrame:
    """`lookup` for rows that lie by their route; `asking` reads the same rows again.

    A parent that lends columns answers for the keys it has, another for those it lacks.
    """
    asks, own = _asks(asking, link, route), F.col(_search(link)) == F.col("_chave")
    found = asks.join(_offered(parent, link), own, "inner" if link.carries else "left")
    if not link.carries:
        found = found.where("_achado is null")
    rows = _met(child, _told(found, link, route, *link.carries), link, route)
    said = F.col("_dito").isNotNull()
    flag = said if link.carries else F.col(link.key).isNotNull() & ~said
    lent = {c: F.col("_dito")[c] for c in link.carries}
    return rows.withColumns({**lent, link.flag: flag}).drop("_dito")


def broken_by_route(
    child: DataFrame,
    asking: DataFrame,
    parent: DataFrame,
    link: Parent,
    route: str,
    beside: tuple[str, ...],
    broken: Column,
    bits: str,
) -> DataFrame:
    """Rows with the rules that their parent breaks, as bits, NULL for none.

    `broken` reads the foreign key, the child's columns `beside` and what the parent lends, and is
    zero for rows without a foreign key. Only broken rules are answered.
    """
    asks = _asks(asking, link, route, *beside)
    asked = asks.join(_offered(parent, link), F.col(_search(link)) == F.col("_chave"), "left")
    asked = asked.withColumn(link.flag, F.col("_achado").isNotNull()).withColumn(link.key, F.col(_search(link)))
    found = asked.withColumn(bits, broken).where(F.col(bits) != 0)
    rows = _met(child, _told(found, link, route, *beside, bits, beside=beside), link, route, beside)
    return rows.withColumn(bits, F.col("_dito")[bits]).drop("_dito")
