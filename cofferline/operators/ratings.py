"""Investment ratios as a sparse long table; what is not held has no row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cofferline.operators.clean import asset_value

ZERO = 1e-12  # smaller centred values are rounding noise of equal weights


@dataclass
class Ratings:
    """(owner, item, ratio), (owner, item, centred, length) and one (owner, mean_ratio) row per owner."""

    cells: DataFrame
    centred: DataFrame
    means: DataFrame


def investment_ratio(
    df: DataFrame,
    owner: str = "owner",
    amount: str = "amount",
    value: str = "value",
    price: str | None = None,
    scale: float = 1.0,
) -> DataFrame:
    """Rows with asset value, portfolio total and their ratio, null where the total is 0.

    Totals are summed where an owner's rows meet, so the rows are made and moved once. Rows without an
    owner are left out.
    """
    rows = df.withColumn("asset_value", asset_value(amount, value, price)).filter(F.col(owner).isNotNull())
    total = F.sum("asset_value").over(Window.partitionBy(owner))
    rest = [name for name in rows.columns if name != owner]
    return rows.select(owner, *rest, total.alias("portfolio_value")).withColumn(
        "ratio", F.try_divide("asset_value", "portfolio_value") * F.lit(float(scale))
    )


def merge_user(base: DataFrame, user: DataFrame, owner: str = "owner") -> DataFrame:
    """Base rows without those of the given users, then the users' own rows."""
    kept = base.join(user.select(owner).distinct(), owner, "left_anti")
    return kept.unionByName(user, allowMissingColumns=True)


def owner_mean(ratios: DataFrame, owner: str = "owner", ratio: str = "ratio") -> DataFrame:
    """Mean ratio per owner over its rows, repeated items counted apart."""
    return ratios.groupBy(owner).agg(F.avg(ratio).alias("mean_ratio"))


def ratio_matrix(
    ratios: DataFrame, owner: str = "owner", item: str = "item", ratio: str = "ratio"
) -> DataFrame:
    """Summed ratio per owner and item, zeros left out."""
    cells = ratios.groupBy(owner, item).agg(F.sum(ratio).alias("ratio"))
    return cells.filter(F.col("ratio") != 0)


def wide_matrix(cells: DataFrame, items: list[str], owner: str = "owner") -> DataFrame:
    """One column per named item, 0 where not held. For small reports."""
    return cells.groupBy(owner).pivot("item", items).agg(F.sum("ratio")).fillna(0.0, subset=items)


def centre(cells: DataFrame, means: DataFrame, owner: str = "owner") -> DataFrame:
    """Ratio minus the owner's mean; cells that become zero count as not held and are left out."""
    return _centred(cells.join(means, owner), owner)


def _centred(rows: DataFrame, owner: str = "owner", *rest: str) -> DataFrame:
    centred = F.col("ratio") - F.col("mean_ratio")
    return rows.select(owner, "item", centred.alias("centred"), *rest).filter(F.abs("centred") >= ZERO)


def rated_cells(
    holdings: DataFrame,
    owner: str = "owner",
    item: str = "item",
    amount: str = "amount",
    value: str = "value",
    price: str | None = None,
) -> DataFrame:
    """(owner, item, ratio, mean_ratio, length), one row per owner and item held.

    Rows are moved once, to the others of their owner; repeated items, totals and lengths are summed there.
    Within an owner the ratios of all rows add up to 1, so their mean is 1 over the number of rows; an
    owner whose total is 0 keeps its rows, with null ratios. ``length`` is that of the owner's centred
    cells, null where it has none. Rows without an owner are left out.
    """
    return shares(asset_sums(holdings, owner, item, amount, value, price)).select("owner", "item", "ratio", "mean_ratio", "length")


def asset_sums(
    holdings: DataFrame, owner: str, item: str, amount: str, value: str, price: str | None = None
) -> DataFrame:
    """(owner, item, asset, n_rows): summed values and the number of rows with a value. All rows of an owner stand
    in one task."""
    rows = holdings.select(
        F.col(owner).alias("owner"), F.col(item).alias("item"), asset_value(amount, value, price).alias("asset")
    )
    return rows.repartition("owner").groupBy("owner", "item").agg(F.sum("asset").alias("asset"), F.count("asset").alias("n_rows"))


def shares(sums: DataFrame, counts: Column | None = None) -> DataFrame:
    """The rows of ``asset_sums`` that have an owner and a value, with ratio, mean_ratio and length.

    Rows for which ``counts`` does not hold are no part of the portfolio and have no ratio.
    """
    rows = sums.filter("owner is not null and n_rows > 0")
    part = (lambda column: column) if counts is None else lambda column: F.when(counts, column)
    mine = Window.partitionBy("owner")
    totals = rows.withColumns(
        {"_total": F.sum(part(F.col("asset"))).over(mine), "_owner_rows": F.sum(part(F.col("n_rows"))).over(mine)}
    )
    rated = totals.withColumns({
        "ratio": part(F.try_divide("asset", "_total")),
        "mean_ratio": F.when(F.col("_total") != 0, 1.0 / F.col("_owner_rows")),
    })
    centred = F.col("ratio") - F.col("mean_ratio")
    square = F.when((F.col("ratio") != 0) & (F.abs(centred) >= ZERO), centred * centred)
    return rated.withColumn("length", F.sqrt(F.sum(square).over(mine))).drop("_total", "_owner_rows")


def as_ratings(rated: DataFrame) -> Ratings:
    """The three tables of ``Ratings`` as cuts of one; centred cells keep the ``length`` of their owner."""
    cells = rated.filter(F.col("ratio") != 0)
    means = rated.groupBy("owner").agg(F.max("mean_ratio").alias("mean_ratio"))
    return Ratings(cells.select("owner", "item", "ratio"), _centred(cells, "owner", "length"), means)


def build_ratings(holdings: DataFrame, user: DataFrame | None = None, **columns: str) -> Ratings:
    """Cells, centred cells and means of holdings with numeric amounts and values.

    ``user`` rows replace those of the same owners; ``columns`` name owner, item, amount, value.
    """
    if user is not None:
        holdings = merge_user(holdings, user, columns.get("owner", "owner"))
    return as_ratings(rated_cells(holdings, **columns))


def replaced_owners(rated: DataFrame, user: DataFrame, **columns: str) -> DataFrame:
    """Rated cells after the rows of some owners were replaced by ``user``, holdings with numbers.

    ``rated`` comes from ``rated_cells``. A cell depends on its owner's rows alone, so only the given
    owners are aggregated; the result equals ``rated_cells`` of all holdings with those rows replaced.
    """
    fresh = rated_cells(user, **columns)
    gone = user.select(F.col(columns.get("owner", "owner")).alias("owner")).distinct()
    return rated.join(gone, "owner", "left_anti").unionByName(fresh.select(rated.columns))
