"""Restaurant reports: dimensional model, dashboards, marts and scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tiffin.functions.columns import above_tier, count_where, mean, money, percent, popularity, ratio, tier, total
from tiffin.operators.aggs import distinct_counts, weighted_mean
from tiffin.operators.quality import Rule, expect
from tiffin.operators.windows import composite_rank, join_beside, latest_per_key, percentiles, ranks, ranks_many

SALES_MEASURES = ("order_count", "revenue_d")


def restaurant_sales(restaurants: DataFrame, sales: DataFrame) -> DataFrame:
    """Restaurants with order count and exact revenue; those without sales have 0 orders and NULL revenue."""
    facts = sales.groupBy("restaurant_id").agg(F.count(F.lit(1)).alias("order_count"), F.sum(money("amount")).alias("revenue_d"))
    return restaurants.join(facts, "restaurant_id", "left").fillna(0, ["order_count"])


# ---------------------------------------------------------------- dimensional model


def silver_restaurants(bronze: DataFrame) -> DataFrame:
    rules = [Rule("valid_restaurant_id", "restaurant_id IS NOT NULL"), Rule("valid_name", "name IS NOT NULL")]
    return expect(bronze, rules).withColumn("name", F.trim("name")).withColumn("city", F.upper(F.trim("city")))


def silver_ratings(bronze: DataFrame, low: float, high: float) -> DataFrame:
    return expect(bronze, [Rule("valid_key", "restaurant_id IS NOT NULL"), Rule("valid_range", F.col("rating").between(low, high))])


def silver_products(bronze: DataFrame) -> DataFrame:
    rules = [Rule("valid_product_id", "product_id IS NOT NULL"), Rule("valid_price", "price > 0")]
    return expect(bronze, rules).withColumn("profit_margin", (money("price") - money("unit_cost")).cast("double"))


def silver_inventory(bronze: DataFrame) -> DataFrame:
    rules = [Rule("valid_keys", "restaurant_id IS NOT NULL AND product_id IS NOT NULL"), Rule("valid_quantity", "quantity >= 0")]
    return expect(bronze, rules)


def distinct_dimension(silver: DataFrame, key: str) -> DataFrame:
    """Every distinct row: a changed row gives a second one."""
    return silver.filter(F.col(key).isNotNull()).distinct()


def latest_dimension(silver: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the newest."""
    return latest_per_key(silver.filter(F.col(key).isNotNull()), [key], order)


def rating_facts(ratings: DataFrame, restaurants: DataFrame) -> DataFrame:
    return ratings.filter(F.col("rating").isNotNull()).join(restaurants.select("restaurant_id"), "restaurant_id")


def inventory_facts(inventory: DataFrame, products: DataFrame, restaurants: DataFrame, product_keys: Sequence[str]) -> DataFrame:
    """Stock with its value. ``product_keys`` says how a product is found; too few keys multiply rows."""
    priced = products.filter(F.col("price").isNotNull()).select(*product_keys, "price")
    return (
        inventory.filter(F.col("quantity") >= 0).join(priced, list(product_keys))
        .join(restaurants.select("restaurant_id"), "restaurant_id")
        .withColumn("inventory_value", money(F.col("quantity") * F.col("price")))
    )


def restaurant_summary(ratings: DataFrame, dim: DataFrame, high: float, low: float, keys: Sequence[str]) -> DataFrame:
    """Ratings per restaurant or per group of them; high and low counts and their share."""
    n, value = F.count("rating"), F.col("rating")
    grouped = ratings.groupBy("restaurant_id").agg(
        n.alias("_n"), F.sum(money("rating")).alias("_sum"),
        count_where(value >= high).alias("_high"), count_where(value <= low).alias("_low"),
    )
    sums = grouped.join(dim.select("restaurant_id", *[k for k in keys if k != "restaurant_id"]), "restaurant_id").groupBy(*keys)
    return sums.agg(
        F.countDistinct("restaurant_id").alias("restaurant_count"), F.sum("_n").alias("total_ratings"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("avg_rating"),
        F.sum("_high").alias("high_ratings_count"), F.sum("_low").alias("low_ratings_count"),
        percent(F.sum("_high"), F.sum("_n")).alias("high_ratings_pct"), percent(F.sum("_low"), F.sum("_n")).alias("low_ratings_pct"),
    )


def stock_per(inventory: DataFrame, key: str, member: str, members: str, measured: str) -> DataFrame:
    """Distinct members, quantity, value, and sum and count of ``measured`` per key.

    The lines are dealt by key and member over all shuffle partitions and summed there first. The number is given, so the adaptive plan does not merge
    them into few tasks that each hold millions of pairs, and a key with most lines is spread over its members.
    """
    parts = int(inventory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return distinct_counts(inventory.repartition(parts, key, member), [key], {members: member}, {
        "_quantity": ("sum", F.col("quantity")), "_value": ("sum", F.col("inventory_value")),
        "_sum": ("sum", money(measured)), "_n": ("count", F.col(measured)),
    })


def product_summary(inventory: DataFrame, products: DataFrame) -> DataFrame:
    per_product = stock_per(inventory, "product_id", "restaurant_id", "restaurants_offering", "quantity").select(
        "product_id", "restaurants_offering", F.col("_quantity").alias("total_quantity"),
        F.col("_value").cast("double").alias("total_inventory_value"), ratio(F.col("_sum"), F.col("_n")).alias("avg_quantity"),
    )
    return per_product.join(products.select("product_id", "product_name", "product_type"), "product_id")


def restaurant_inventory(inventory: DataFrame, dim: DataFrame) -> DataFrame:
    per_restaurant = stock_per(inventory, "restaurant_id", "product_id", "unique_products", "inventory_value").select(
        "restaurant_id", "unique_products", F.col("_quantity").alias("total_items"),
        F.col("_value").cast("double").alias("total_inventory_value"), ratio(F.col("_sum"), F.col("_n")).alias("avg_product_value"),
    )
    return per_restaurant.join(dim.select("restaurant_id", "name", "city"), "restaurant_id")


def city_summary(dim: DataFrame, ratings: DataFrame, inventory: DataFrame, pre_aggregate: bool = False) -> DataFrame:
    """Restaurants, ratings and stock value per city.

    The plain form repeats a restaurant's stock for each of its ratings, so the average is weighted by ratings;
    ``pre_aggregate`` counts each restaurant once. Both come from per-restaurant sums, not from the multiplied rows. ``total_ratings`` counts each
    ``rating_id``, which belongs to one restaurant, once, however often it was delivered.
    """
    rated = ratings.groupBy("restaurant_id").agg(
        F.count("rating").alias("_n"), F.sum(money("rating")).alias("_sum"), F.countDistinct("rating_id").alias("_ids")
    )
    stock = inventory.groupBy("restaurant_id").agg(F.sum("inventory_value").alias("_value"))
    joined = dim.join(rated, "restaurant_id", "left").join(stock, "restaurant_id", "left").fillna(0, ["_n", "_ids"])
    weight = F.lit(1) if pre_aggregate else F.greatest("_n", F.lit(1))
    known = F.when(F.col("_value").isNotNull(), weight)
    return joined.groupBy("city").agg(
        F.countDistinct("restaurant_id").alias("restaurant_count"), F.sum("_ids").alias("total_ratings"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("avg_rating"),
        ratio(F.sum(F.col("_value") * known), F.sum(known)).alias("avg_inventory_value"),
    )


# ---------------------------------------------------------------- dashboards


def performance_dashboard(restaurants: DataFrame, sales: DataFrame, tiers, scale: int = 1000) -> DataFrame:
    """Restaurant sales with distance from the cuisine average and revenue ranks in cuisine and city."""
    base = restaurant_sales(restaurants, sales)
    stats = base.groupBy("cuisine").agg((F.sum(money("rating")).cast("double") / F.count("rating")).alias("_avg_rating"))
    joined = base.join(stats, "cuisine")
    ranked = ranks_many(joined, [
        (["cuisine"], "revenue_d", {"revenue_rank_in_cuisine": "rank"}), (["city"], "revenue_d", {"revenue_rank_in_city": "rank"})
    ])
    return ranked.select(
        "restaurant_id", "name", "cuisine", "city", "rating",
        ((F.col("rating") - F.col("_avg_rating")) / F.col("_avg_rating") * 100).alias("rating_vs_cuisine_pct"),
        "order_count", F.col("revenue_d").cast("double").alias("total_revenue"),
        ratio(F.col("revenue_d"), F.col("order_count")).alias("avg_order_value"),
        popularity("rating", "reviews", scale).alias("popularity_score"),
        "revenue_rank_in_cuisine", "revenue_rank_in_city", tier("rating", tiers, "Below Average").alias("rating_category"),
    )


def comprehensive_performance(restaurants: DataFrame, sales: DataFrame, scale: int = 1000) -> DataFrame:
    """Performance score with dense ranks in cuisine, in city and overall."""
    base = restaurant_sales(restaurants, sales)
    per_order = F.col("revenue_d").cast("double") / F.nullif(F.col("order_count"), F.lit(0))
    scored = base.withColumn("performance_score", per_order * F.sqrt(F.col("reviews") / F.lit(scale)))
    groups = ((["cuisine"], "cuisine_rank"), (["city"], "city_rank"), ([], "overall_rank"))
    ranked = ranks_many(scored, [(keys, "performance_score", {out: "dense_rank"}) for keys, out in groups])
    return ranked.withColumn("total_revenue", F.coalesce(F.col("revenue_d").cast("double"), F.lit(0.0))).drop("revenue_d")


def cuisine_analysis(restaurants: DataFrame, sales: DataFrame, high: float) -> DataFrame:
    """Ratings and sales per cuisine with deviation and exact median."""
    base = restaurant_sales(restaurants, sales)
    stats = base.groupBy("cuisine").agg(
        F.count(F.lit(1)).alias("restaurant_count"), mean("rating").alias("avg_rating"),
        F.round(F.stddev_samp("rating"), 4).alias("rating_stddev"), count_where(F.col("rating") >= high).alias("high_rated_count"),
        F.sum("order_count").alias("order_count"), F.sum("revenue_d").cast("double").alias("total_revenue"),
        ratio(F.sum("revenue_d"), F.count(F.lit(1))).alias("revenue_per_restaurant"),
        ratio(F.sum("order_count"), F.count(F.lit(1))).alias("orders_per_restaurant"),
    )
    medians = percentiles(restaurants, ["cuisine"], "rating", {"median_rating": 0.5})
    return join_beside(stats, medians, ["cuisine"]).withColumn("median_rating", F.round("median_rating", 6))


def driver_ranking(drivers: DataFrame, sales: DataFrame) -> DataFrame:
    """Deliveries per driver with their rank by value."""
    facts = sales.groupBy("driver_id").agg(F.count(F.lit(1)).alias("delivery_count"), F.sum(money("amount")).alias("value_d"))
    joined = ranks(drivers.join(facts, "driver_id"), [], "value_d", {"earnings_rank": "rank"}, descending=True)
    return joined.select(
        "driver_id", "driver_name", "vehicle", "city", "delivery_count", F.col("value_d").cast("double").alias("total_delivery_value"),
        ratio(F.col("value_d"), F.col("delivery_count")).alias("avg_delivery_value"), "earnings_rank",
    )


def city_analysis(restaurants: DataFrame, sales: DataFrame) -> DataFrame:
    """City figures with four ranks and their mean."""
    base = restaurant_sales(restaurants, sales)
    served = sales.select("restaurant_id", "driver_id").distinct().join(restaurants.select("restaurant_id", "city"), "restaurant_id")
    drivers = served.groupBy("city").agg(F.countDistinct("driver_id").alias("driver_count"))
    # The reported average repeats a restaurant for each of its orders.
    weight = F.greatest("order_count", F.lit(1))
    cities = base.groupBy("city").agg(
        F.count(F.lit(1)).alias("restaurant_count"),
        ratio(F.sum(money("rating") * weight), F.sum(weight)).alias("avg_rating"),
        F.sum("order_count").alias("order_count"), F.sum("revenue_d").cast("double").alias("total_revenue"),
    ).join(drivers, "city", "left").fillna(0, ["driver_count"])
    return composite_rank(
        cities, ["restaurant_count", "avg_rating", "total_revenue", "driver_count"], "overall_performance_score"
    )


def driver_efficiency(drivers: DataFrame, sales: DataFrame, shifts: DataFrame, pre_aggregate: bool = True) -> DataFrame:
    """Orders and revenue per hour and kilometre.

    Joining orders and shifts of a driver multiplies both sums. ``pre_aggregate=False`` gives those multiplied sums,
    from the counts on each side rather than from the multiplied rows.
    """
    facts = sales.groupBy("driver_id").agg(F.count(F.lit(1)).alias("orders"), F.sum(money("amount")).alias("revenue_d"))
    work = shifts.groupBy("driver_id").agg(
        F.count(F.lit(1)).alias("shifts"), F.sum(money("shift_minutes")).alias("minutes_d"), F.sum(money("distance_km")).alias("km_d")
    )
    joined = drivers.join(facts, "driver_id", "left").join(work, "driver_id", "left")
    by_shift = F.lit(1) if pre_aggregate else F.greatest(F.coalesce("shifts", F.lit(1)), F.lit(1))
    by_order = F.lit(1) if pre_aggregate else F.greatest(F.coalesce("orders", F.lit(1)), F.lit(1))
    sums = joined.select(
        "driver_id", "driver_name", "vehicle", "city",
        F.coalesce(F.col("orders") * by_shift, F.lit(0)).alias("order_count"),
        (F.col("revenue_d") * by_shift).cast("double").alias("total_revenue"),
        (F.col("minutes_d") * by_order).cast("double").alias("total_minutes"),
        (F.col("km_d") * by_order).cast("double").alias("total_km"),
    ).filter(F.col("total_minutes") > 0)
    hours = F.nullif(F.col("total_minutes") / 60, F.lit(0.0))
    orders = F.nullif(F.col("order_count"), F.lit(0))
    rated = sums.withColumns({
        "orders_per_hour": F.col("order_count") / hours, "revenue_per_hour": F.col("total_revenue") / hours,
        "revenue_per_order": F.col("total_revenue") / orders, "km_per_order": F.col("total_km") / orders,
    })
    return ranks(rated, ["vehicle"], "revenue_per_hour", {"efficiency_rank": "rank"}, descending=True)


def analytics_mart(restaurants: DataFrame, sales: DataFrame, year: int) -> DataFrame:
    """Restaurant mart: sales, active months, one year's sales, lunch and dinner orders, place in cuisine and city."""
    hour, this_year = F.hour("order_date"), F.year("order_date") == year
    facts = sales.groupBy("restaurant_id").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum(money("amount")).alias("revenue_d"),
        F.countDistinct(F.date_format("order_date", "yyyy-MM")).alias("active_months"),
        count_where(this_year).alias("orders_year"), F.sum(F.when(this_year, money("amount")).otherwise(F.lit(0))).cast("double").alias("revenue_year"),
        count_where(hour.between(11, 14)).alias("lunch_orders"), count_where(hour.between(18, 21)).alias("dinner_orders"),
    )
    counts = ["order_count", "active_months", "orders_year", "lunch_orders", "dinner_orders"]
    placed = ranks_many(restaurants, [(["cuisine"], "rating", {"_place": "percent_rank"}, False), (["city"], "rating", {"rank_in_city": "dense_rank"}, True)])
    mart = placed.join(facts, "restaurant_id", "left").fillna(0, [*counts, "revenue_year"])
    place = tier("_place", [(0.8, "Top 20%"), (0.5, "Above Average"), (0.2, "Below Average")], "Bottom 20%")
    return mart.select(
        *restaurants.columns, *counts, F.col("revenue_d").cast("double").alias("total_revenue"), "revenue_year",
        ratio(F.col("revenue_d"), F.col("order_count")).alias("avg_order_value"), place.alias("cuisine_percentile"), "rank_in_city",
    )


def mart_kpis(mart: DataFrame, tiers, high: float, medium: float) -> DataFrame:
    """KPI view over the mart."""
    return mart.select(
        "restaurant_id", "cuisine", "city", "order_count", "total_revenue",
        (F.col("total_revenue") / F.nullif(F.col("order_count"), F.lit(0))).alias("revenue_per_order"),
        tier("rating", tiers, "Below Average").alias("rating_category"),
        above_tier("total_revenue", [(high, "High Revenue"), (medium, "Medium Revenue")], "Low Revenue").alias("revenue_category"),
        "rank_in_city",
    )


def performance_score(restaurants: DataFrame, sales: DataFrame) -> DataFrame:
    """Weighted score of revenue, rating and orders, each against its maximum; a maximum of zero counts as one."""
    base = restaurant_sales(restaurants, sales).withColumn("revenue_d", F.coalesce("revenue_d", F.lit(0).cast("decimal(28,2)")))
    tops = base.agg(
        F.struct(F.max("revenue_d").cast("double").alias("revenue"), F.max("rating").alias("rating"), F.max("order_count").alias("orders"))
    ).scalar()
    share = lambda value, top: value / F.when(top > 0, top).otherwise(F.lit(1))
    score = (
        0.4 * share(F.col("revenue_d").cast("double"), F.col("_tops.revenue")) + 0.3 * share(F.col("rating"), F.col("_tops.rating"))
        + 0.3 * share(F.col("order_count"), F.col("_tops.orders"))
    )
    return base.withColumn("_tops", tops).withColumn("performance_score", score).drop("_tops")


def ranked_scores(scored: DataFrame) -> DataFrame:
    """Scores beside the average ranks by revenue, rating and orders within the cuisine."""
    columns = (("revenue_d", "revenue_rank"), ("rating", "rating_rank"), ("order_count", "order_rank"))
    ranked = ranks_many(scored, [(["cuisine"], by, {out: "average_rank"}) for by, out in columns])
    return ranked.withColumn("total_revenue", F.col("revenue_d").cast("double")).drop("revenue_d")


def cuisine_scores(scored: DataFrame) -> DataFrame:
    """Restaurants, ratings, orders, revenue and mean score per cuisine."""
    exact = F.col("performance_score").cast("decimal(18,9)")
    return scored.groupBy("cuisine").agg(
        F.count(F.lit(1)).alias("restaurant_count"), mean("rating").alias("avg_rating"), F.sum("order_count").alias("total_orders"),
        F.sum("revenue_d").cast("double").alias("total_revenue"),
        F.round(F.sum(exact).cast("double") / F.count(F.lit(1)), 6).alias("avg_performance"),
    )


def rating_dashboard(restaurants: DataFrame, scale: int = 1000) -> dict[str, DataFrame]:
    """Cuisine and city figures and the rating distribution."""
    return {
        "cuisine": restaurants.groupBy("cuisine").agg(
            F.count(F.lit(1)).alias("restaurant_count"), mean("rating").alias("avg_rating"), F.sum("reviews").alias("total_reviews"),
            F.round(weighted_mean("rating", "reviews"), 6).alias("weighted_rating"),
        ).filter(F.col("restaurant_count") > 1),
        "city": restaurants.groupBy("city").agg(
            F.count(F.lit(1)).alias("restaurant_count"), mean("rating").alias("avg_rating"), mean("reviews", 0).alias("avg_reviews"),
            total("reviews").alias("total_reviews"),
        ).filter(F.col("restaurant_count") > 1),
        "distribution": restaurants.groupBy((F.floor(F.col("rating") / 10) * 10).alias("rating_bucket")).agg(F.count(F.lit(1)).alias("restaurant_count")),
        "top": restaurants.withColumn("popularity_score", popularity("rating", "reviews", scale))
        .orderBy(F.col("popularity_score").desc(), "restaurant_id").limit(20),
    }
