"""Reports for a table of scopes (J1, J2, J4), from one lattice of scope keys.

The analyses are not run scope by scope.  Each fact is read once and counted
over the finest combination of its group and the scope keys that its analyses
honour (a cuboid, small beside the fact); the combinations of keys that were
asked for are grouping sets of that cuboid, and a scope's report is looked up
by the scope's text.

A key that needs a dimension joins it only where a scope names the key (C12),
and a repeated dimension row fans out.  Both are kept: beside its own row, a
fact has one for each place it joins, weighted by how often, and a combination
counts the first kind or the second.  Facts are counted by the places of their
order first, which are few, and only these counts are repeated place by place.
Distinct orders do not add up, so their analysis counts orders by their places
and by each category, and an order counts once in each combination that it has
there.

A fact is shuffled by order once, and each step's shuffle files are removed when
it is checkpointed, so the disk holds those of one step at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starlens.functions.numeric import MONEY, pct
from starlens.functions.scope import HONOURED, Scope
from starlens.operators import dims
from starlens.operators.analyses import ANALYSES, DEFAULT_TOP_N
from starlens.operators.questions import question_scope, user_questions
from starlens.session import freed_shuffles, shared_dir
from starlens.sources.star import Star

Keys = frozenset[str]
EVERYTHING = Scope()
PLACES = "array<struct<located:boolean,region:string,city:string,times:bigint>>"
# Money is summed over orders in whole units of its last decimal: products of wide decimals would lose some.
UNIT = 10**10


def scope_text(entries: Sequence[tuple[str, Column]]) -> Column:
    """The JSON text of a scope, keys in order."""
    if not entries:
        return F.lit("{}")
    return F.to_json(F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), c.cast("string").alias("value")) for k, c in sorted(entries, key=lambda e: e[0])])))


def asked_keys(scopes: DataFrame, scope: str = "scope") -> set[Keys]:
    """The combinations of keys that occur: at most 256 rows of key names."""
    return {frozenset(r[0]) for r in scopes.select(F.array_sort(F.map_keys(scope)).alias("k")).distinct().collect()}


def _honoured(asked: Iterable[Keys], analysis: str) -> set[Keys]:
    return {k & frozenset(HONOURED[analysis]) for k in asked}


def _at(fact: DataFrame, places: DataFrame | None, key: str) -> DataFrame:
    """``fact`` with the ``places`` of its key, null where it has none."""
    return fact.withColumn("places", F.lit(None).cast(PLACES)) if places is None else fact.join(places, key, "left")


def _placed(fact: DataFrame) -> DataFrame:
    """``fact`` with (located, region, city, times) for its ``places``: each
    row once unlocated, and once for each place."""
    own = F.struct(F.lit(False).alias("located"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("string").alias("city"), F.lit(1).cast("long").alias("times"))
    others = [c for c in fact.columns if c != "places"]
    each = F.concat(F.array(own), F.coalesce("places", F.array().cast(PLACES)))
    return fact.select(*others, F.explode(each).alias("p")).select(*others, "p.*")


def _by_key(located: DataFrame, key: str) -> DataFrame:
    """(key, places): the distinct places of a key and how often it has each, in
    one order, so that keys of the same places are told by them.  Null keys
    join with nothing and go.  Rows are dealt by key once for both counts."""
    counted = located.where(F.col(key).isNotNull()).repartition(key).groupBy(key, "region_name", "city").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.lit(True).alias("located"), F.col("region_name").alias("region"), F.col("city").alias("city"), F.col("n").alias("times"))
    return counted.groupBy(key).agg(F.array_sort(F.collect_list(place)).cast(PLACES).alias("places"))


def _by_columns(label: str, columns: Mapping[str, str], sets: Iterable[Keys]) -> tuple[list[str], dict[tuple[str, ...], list[Keys]]]:
    """The columns that some combination of keys adds to the label, and the combinations by those that they add."""
    sets = sorted(sets, key=sorted)
    free = sorted({columns[k] for s in sets for k in s} - {label})
    by_columns: dict[tuple[str, ...], list[Keys]] = {}
    for s in sets:
        by_columns.setdefault(tuple(c for c in free if c in {columns[k] for k in s}), []).append(s)
    return free, by_columns


def _long(analysis: str, grouped: DataFrame, label: str, columns: Mapping[str, str], sets: Iterable[tuple[int, list[Keys]]], value: Column) -> DataFrame:
    """(analysis, scope_key, dimension, value) of groups whose ``_gid`` tells the combinations of keys that they are for."""
    keys = F.lit(None).cast("array<string>")
    for gid, of in sets:
        texts = F.array(*[scope_text([(k, F.col(columns[k])) for k in s]) for s in of])
        keys = F.when(F.col("_gid") == gid, texts).otherwise(keys)
    return grouped.select(F.lit(analysis).alias("analysis"), F.explode(keys).alias("scope_key"), F.col(label).cast("string").alias("dimension"),
                          value.cast("double").alias("value"))


def _cells(analysis: str, cuboid: DataFrame, label: str, columns: Mapping[str, str], sets: Iterable[Keys], aggs: Mapping[str, Column],
           value: Column, having: Column | None = None) -> DataFrame:
    """(analysis, scope_key, dimension, value): ``cuboid`` aggregated by its
    label and each combination of keys, as grouping sets."""
    free, by_columns = _by_columns(label, columns, sets)
    grouped = cuboid.groupingSets([[label, *cols] for cols in by_columns], label, *free).agg(
        *(c.alias(n) for n, c in aggs.items()), F.grouping_id(label, *free).alias("_gid"))
    if having is not None:
        grouped = grouped.where(having)
    gids = [(sum(1 << (len(free) - 1 - i) for i, c in enumerate(free) if c not in cols), of) for cols, of in by_columns.items()]
    return _long(analysis, grouped, label, columns, gids, value)


def _distinct_cells(analysis: str, counted: DataFrame, at: Column, label: str, columns: Mapping[str, str], sets: Iterable[Keys]) -> DataFrame:
    """As ``_cells``, counting distinct keys: ``counted`` has the number ``n`` of
    keys, each in one row, whose places are those of ``at``.  A key counts once
    in each combination that it has there, so no key is shuffled again."""
    free, by_columns = _by_columns(label, columns, sets)
    seen = [F.array_distinct(F.transform(at, lambda x: F.struct(  # noqa: B023
        F.lit(k).alias("_gid"), x[label].alias(label), *[(x[c] if c in cols else F.lit(None).cast("string")).alias(c) for c in free])))
        for k, cols in enumerate(by_columns)]
    grouped = counted.where("n > 0").select("n", F.explode(F.concat(*seen)).alias("x")).select("n", "x.*").groupBy("_gid", label, *free).agg(F.sum("n").alias("n"))
    return _long(analysis, grouped, label, columns, enumerate(by_columns.values()), F.col("n"))


def _split(sets: Iterable[Keys], *needs: str) -> tuple[set[Keys], set[Keys]]:
    """The combinations without any of the keys, and those with one."""
    sets = set(sets)
    some = {s for s in sets if s & set(needs)}
    return sets - some, some


def _total(c: str) -> Column:
    return F.sum(c)


class Lattice:
    """The cells of all analyses of a star for some combinations of keys."""

    def __init__(self, star: Star, asked: Iterable[Keys]):
        self.star, self.asked = star, set(asked) | {frozenset()}
        shared_dir(star.spark)
        star.check_dimensions()
        self.located = any(k & {"region", "city"} for k in self.asked)
        self.order_places = _by_key(dims.orders_located(star, EVERYTHING), "order_id").checkpoint()

    @property
    def asked_places(self) -> DataFrame | None:
        """The places of orders, where some combination names one."""
        return self.order_places if self.located else None

    def sets(self, analysis: str) -> set[Keys]:
        return _honoured(self.asked, analysis)

    def payments(self) -> list[DataFrame]:
        star, sums = self.star, ["method_id", "payment_status", "failure_reason", "located", "region", "city"]
        rows = _at(star["fact_payments"].select("order_id", "method_id", "payment_status", "failure_reason"), self.asked_places, "order_id")
        counted = rows.groupBy("method_id", "payment_status", "failure_reason", "places").agg(F.count(F.lit(1)).alias("n"))
        cuboid = _placed(counted).groupBy(*sums).agg(F.sum(F.col("n") * F.col("times")).alias("n")).checkpoint()
        methods = star.broadcast(star["dim_payment_methods"].select("method_id", "method_name"), "dim_payment_methods")
        named, out = cuboid.join(methods, "method_id"), []
        columns = {"payment_status": "payment_status", "payment_method": "method_name", "region": "region", "city": "city"}
        failed = F.col("payment_status") == "failed"
        for with_place, sets in enumerate(_split(self.sets("payment_failure_by_method"), "region", "city")):
            if sets:
                out.append(_cells("payment_failure_by_method", named.where(F.col("located") == bool(with_place)), "method_name", columns, sets,
                                  {"total": _total("n"), "failed": F.sum(F.when(failed, F.col("n")).otherwise(0))},
                                  F.coalesce(pct("failed", "total"), F.lit(0))))
        stated = failed & F.col("failure_reason").isNotNull()
        for with_method, some in enumerate(_split(self.sets("payment_failure_by_reason"), "payment_method")):
            for with_place, sets in enumerate(_split(some, "region")):
                if sets:
                    of = (named if with_method else cuboid).where(stated & (F.col("located") == bool(with_place)))
                    out.append(_cells("payment_failure_by_reason", of, "failure_reason", columns, sets, {"n": _total("n")}, F.col("n")))
        return out

    @cached_property
    def sold(self) -> DataFrame:
        """(category_name, places, n, exact, odd): distinct orders and sums of
        the lines of a category, by the places of their orders.  A line is
        dealt by sku and by order once."""
        star, x = self.star, F.col("line_value")
        lines = star["fact_order_lines"].select("order_id", "sku_id", "line_value").join(dims.small_sku_category(star, EVERYTHING), "sku_id")
        odd = F.isnan(x) | (F.abs(x) == float("inf"))
        units = (F.when(~odd, x).cast(MONEY) * F.lit(UNIT).cast("decimal(11,0)")).cast("decimal(28,0)")
        rows = _at(lines.select("order_id", "category_name", "line_value"), self.order_places, "order_id").groupBy("order_id", "category_name", "places").agg(
            F.sum(units).alias("exact"), F.sum(F.when(odd, x.cast("double"))).alias("odd"))
        return rows.groupBy("category_name", "places").agg(F.count("order_id").alias("n"), F.sum("exact").alias("exact"), F.sum("odd").alias("odd")).checkpoint()

    def orders(self) -> list[DataFrame]:
        columns, out = {"region": "region_name", "city": "city", "category": "category_name"}, []
        plain, with_category = _split(self.sets("orders_by_region"), "category")

        def at(*more: Column) -> Column:
            return F.transform("places", lambda x: F.struct(x["region"].alias("region_name"), x["city"].alias("city"), *more))

        if plain:
            located = self.order_places.groupBy("places").agg(F.count(F.lit(1)).alias("n"))
            out.append(_distinct_cells("orders_by_region", located, at(), "region_name", columns, plain))
        if with_category:
            out.append(_distinct_cells("orders_by_region", self.sold, at(F.col("category_name")), "region_name", columns, with_category))
        return out

    def revenue(self) -> list[DataFrame]:
        out, times = [], F.col("times").cast("decimal(9,0)")
        cuboid = _placed(self.sold).groupBy("category_name", "located", "region").agg(
            F.sum(F.col("exact") * times).alias("exact"), F.sum("odd").alias("odd")).checkpoint()
        cents = F.round("e", -8).cast("decimal(38,0)") / F.lit(UNIT).cast("decimal(11,0)")  # rounded once, as a whole number
        for with_place, sets in enumerate(_split(self.sets("revenue_by_category"), "region")):
            if sets:
                out.append(_cells("revenue_by_category", cuboid.where(F.col("located") == bool(with_place)), "category_name",
                                  {"category": "category_name", "region": "region"}, sets, {"e": _total("exact"), "o": _total("odd")},
                                  F.coalesce("o", cents.cast("double"), F.lit(0.0))))
        return out

    def shipments(self) -> list[DataFrame]:
        rows = _at(self.star["fact_shipments"].select("order_id", "shipment_id", "courier_name"), self.order_places, "order_id")
        counted = rows.groupBy("courier_name", "places").agg(F.count(F.lit(1)).alias("n"), F.count("shipment_id").alias("s"))
        cuboid = _placed(counted).groupBy("courier_name", "located", "region").agg(
            *[F.sum(F.col(c) * F.col("times")).alias(c) for c in ("n", "s")]).checkpoint()
        columns, out = {"courier_name": "courier_name", "region": "region"}, []
        for with_place, sets in enumerate(_split(self.sets("courier_performance"), "region")):
            if sets:
                out.append(_cells("courier_performance", cuboid.where(F.col("located") == bool(with_place)), "courier_name", columns, sets, {"n": _total("n")}, F.col("n")))
        out.append(_cells("shipments_by_region", cuboid.where("located"), "region", columns, self.sets("shipments_by_region"), {"s": _total("s")}, F.col("s")))
        return out

    def returns(self) -> list[DataFrame]:
        star, out = self.star, []
        returns = star["fact_returns"].select("line_id", "return_id", "return_reason")
        lines = star["fact_order_lines"].select("line_id", "order_id", "sku_id")
        cuboid = _placed(_at(lines.join(returns, "line_id").drop("line_id"), self.asked_places, "order_id")).groupBy("sku_id", "return_reason", "located", "region").agg(
            F.sum("times").alias("n"), F.sum(F.when(F.col("return_id").isNotNull(), F.col("times")).otherwise(0)).alias("r")).checkpoint()
        columns = {"return_reason": "return_reason", "category": "category_name", "region": "region"}
        for with_category, some in enumerate(_split(self.sets("return_rate_by_sku"), "category")):
            for with_place, sets in enumerate(_split(some, "region")):
                if sets:
                    of = cuboid.where(F.col("located") == bool(with_place))
                    of = of.join(dims.small_sku_category(star, EVERYTHING), "sku_id") if with_category else of
                    out.append(_cells("return_rate_by_sku", of, "sku_id", columns, sets, {"r": _total("r")}, F.col("r"), F.col("r") > 0))
        plain, with_place = _split(self.sets("return_reasons"), "region")
        if plain:
            out.append(_cells("return_reasons", returns.withColumn("n", F.lit(1).cast("long")), "return_reason", columns, plain, {"n": _total("n")}, F.col("n")))
        if with_place:
            out.append(_cells("return_reasons", cuboid.where("located"), "return_reason", columns, with_place, {"n": _total("n")}, F.col("n")))
        return out

    def inventory(self) -> list[DataFrame]:
        star, out = self.star, []
        cuboid = star["fact_inventory_transactions"].groupBy("warehouse_id").agg(F.sum("quantity_change").alias("n")).checkpoint()
        for with_region, sets in enumerate(_split(self.sets("inventory_by_warehouse"), "region")):
            if sets:
                region = star.broadcast(dims.warehouse_region(star, EVERYTHING), "dim_warehouses", "dim_regions")
                of = cuboid.join(region, "warehouse_id") if with_region else cuboid
                out.append(_cells("inventory_by_warehouse", of, "warehouse_id", {"region": "region_name"}, sets, {"n": _total("n")}, F.col("n")))
        return out

    def clicks(self) -> list[DataFrame]:
        star, out = self.star, []
        places = _by_key(dims.customer_location(star, EVERYTHING), "customer_id") if self.located else None
        rows = _at(star["fact_user_clickstream"].select("customer_id", "device_type", "event_type"), places, "customer_id")
        counted = rows.groupBy("device_type", "event_type", "places").agg(F.count(F.lit(1)).alias("n"))
        cuboid = _placed(counted).groupBy("device_type", "event_type", "located", "region").agg(F.sum(F.col("n") * F.col("times")).alias("n")).checkpoint()
        for analysis, label in (("clickstream_by_device", "device_type"), ("clickstream_funnel", "event_type")):
            for with_place, sets in enumerate(_split(self.sets(analysis), "region")):
                if sets:
                    out.append(_cells(analysis, cuboid.where(F.col("located") == bool(with_place)), label,
                                      {"device_type": "device_type", "region": "region"}, sets, {"n": _total("n")}, F.col("n")))
        return out

    def cells(self) -> DataFrame:
        """(analysis, scope_key, dimension, value) of every analysis."""
        parts = [*self.payments(), *self.orders(), *self.revenue(), *self.shipments(), *self.returns(), *self.inventory(), *self.clicks()]
        return reduce(DataFrame.unionByName, parts)


def reports_for(star: Star, scopes: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """(scope_json, analysis, dimension, value): ``report_long`` of every
    distinct scope of ``scopes`` (a column ``scope_json``), checkpointed.

    A scope that is null or no JSON object is the empty one; keys that an
    analysis does not honour are ignored by it, values compared as text."""
    text = F.coalesce(F.from_json("scope_json", "map<string,string>"), F.create_map().cast("map<string,string>"))
    known = F.map_filter(text, lambda k, v: k.isin(*sorted({k for ks in HONOURED.values() for k in ks})))
    shared_dir(star.spark)
    asked = scopes.select("scope_json").distinct().select("scope_json", known.alias("scope")).checkpoint()
    lattice = Lattice(star, asked_keys(asked))

    def key_of(analysis: str) -> Column:
        mine = F.map_filter(F.col("scope"), lambda k, v: k.isin(*HONOURED[analysis]))
        return F.struct(F.lit(analysis).alias("analysis"), F.to_json(F.map_from_entries(F.array_sort(F.map_entries(mine)))).alias("scope_key"))

    wanted = asked.select("scope_json", F.explode(F.array(*[key_of(a) for a in ANALYSES])).alias("k")).select("scope_json", "k.*").checkpoint()
    cells = lattice.cells().join(wanted.select("analysis", "scope_key").distinct(), ["analysis", "scope_key"], "left_semi")
    top = cells.where("analysis = 'return_rate_by_sku'")
    place = F.row_number().over(Window.partitionBy("scope_key").orderBy(F.desc_nulls_first("value"), F.asc_nulls_last("dimension")))
    top = top.withColumn("_k", place).where(F.col("_k") <= top_n).drop("_k")
    cells = cells.where("analysis <> 'return_rate_by_sku'").unionByName(top)
    return cells.join(wanted, ["analysis", "scope_key"]).select("scope_json", "analysis", "dimension", "value").checkpoint()


def report_by_question(star: Star, questions: DataFrame, id_cols: tuple[str, ...] = ("conv_id", "turn"), text_col: str = "text",
                       vocab: DataFrame | None = None) -> DataFrame:
    """(id_cols..., analysis, dimension, value): for every question the long
    report of the scope that its text names.  Questions of one scope share its
    report; a scope that very many ask is a plain join key, which AQE splits."""
    with freed_shuffles(star.spark):
        scopes = question_scope(star, questions, id_cols, text_col, vocab).select(*id_cols, "scope_json").checkpoint()
        reports = reports_for(star, scopes)
    # Row by row of the reports, of which a scope has more than questions: stored results repeat a row's values in runs.
    return reports.join(scopes, "scope_json").select(*id_cols, "analysis", "dimension", "value")


# What the questions of ``asked_questions`` name, in turn.
PHRASES = (
    "", "in ASIA", "about COURIER_A", "about COURIER_A in ASIA", "in NATION_2", "failed payments by HIGH", "damaged PROMO returns",
    "on mobile in EUROPE", "not needed, PROMO, in EUROPE", "failed by HIGH in NATION_2, ASIA, PROMO, COURIER_A, damaged, mobile",
)


def asked_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user turns of the conversations, each with a phrase that names scope values."""
    phrase = F.array(*[F.lit(p) for p in PHRASES])
    at = F.pmod(F.col("conv_id") + F.col("turn"), F.lit(len(PHRASES))).cast("int")
    return user_questions(spark, sf_dir).withColumn("text", F.concat_ws(" ", F.coalesce("text", F.lit("")), F.get(phrase, at)))
