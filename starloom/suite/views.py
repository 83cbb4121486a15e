"""The two domains as views over the driver tables, in Spark and in SQL.

Every view covers its whole tables. Remainders of ids only fill columns: they
place nulls, invalid codes and ties where the operators must handle them.

``play_log``   lineitem with its part (and, where a user is needed, its order);
               sign-out rows have no song, discounted rows report a length that
               is one second off, so exact lookups miss.
``catalog``    part; title and artist are not unique, an artist has many songs.
``arrivals``   orders with their customer, in the raw record format.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.plans.arrivals import Dimensions, latest_gdp


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its schema is looked up once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _artist(part_key: str = "p_partkey") -> F.Column:
    return F.concat_ws(" / ", F.col("p_brand"), F.expr(f"{part_key} div 64").cast("string"))


def play_log(spark: SparkSession, sf_dir: str, with_user: bool = False) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    log = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    # null-safe tests, one per branch: a filter on the page then folds into one on the flag and reaches the scan
    flag = F.col("l_returnflag")
    sung = ~flag.eqNullSafe("R")
    other_page = F.when(flag.eqNullSafe("A"), "Home").otherwise("Logout")
    columns = {
        "ts": F.unix_millis(F.col("l_shipdate").cast("timestamp")) + (F.col("l_orderkey") % 86400) * 1000 + F.col("l_linenumber"),
        "page": F.when(flag.eqNullSafe("N"), "NextSong").otherwise(other_page),
        "level": F.when(F.col("l_linestatus") == "F", "free").otherwise("paid"),
        "song": F.when(sung, F.col("p_name")),
        "artist": F.when(sung, _artist()),
        "length": F.when(sung, F.floor("p_retailprice").cast("double") + F.when(F.col("l_discount") > 0.085, 1.0).otherwise(0.0)),
        "sessionId": F.col("l_orderkey"),
        "itemInSession": F.col("l_linenumber"),
    }
    if with_user:
        orders = table(spark, sf_dir, "orders")
        log = log.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        columns |= {
            "userId": F.col("o_custkey").cast("string"),
            "firstName": F.concat(F.lit("First"), (F.col("o_custkey") % 50).cast("string")),
            "lastName": F.concat(F.lit("Last"), F.col("o_custkey").cast("string")),
            "gender": F.when(F.col("o_custkey") % 2 == 0, "F").otherwise("M"),
            "location": F.col("o_orderpriority"),
            "userAgent": F.col("o_orderstatus"),
        }
    else:
        columns |= {"userId": F.lit(None).cast("string")}
    return log.select(*[c.alias(n) for n, c in columns.items()])


PLAY_LOG_SQL = """
play_log AS (
  SELECT epoch_ms(l_shipdate) + (l_orderkey % 86400) * 1000 + l_linenumber AS ts,
         CASE l_returnflag WHEN 'N' THEN 'NextSong' WHEN 'A' THEN 'Home' ELSE 'Logout' END AS page,
         CASE l_linestatus WHEN 'F' THEN 'free' ELSE 'paid' END AS level,
         CASE WHEN l_returnflag <> 'R' THEN p_name END AS song,
         CASE WHEN l_returnflag <> 'R' THEN p_brand || ' / ' || (p_partkey // 64)::VARCHAR END AS artist,
         CASE WHEN l_returnflag <> 'R'
              THEN floor(p_retailprice) + CASE WHEN l_discount > 0.085 THEN 1 ELSE 0 END END AS length,
         l_orderkey AS sessionId, l_linenumber AS itemInSession,
         o_custkey::VARCHAR AS userId,
         'First' || (o_custkey % 50)::VARCHAR AS firstName,
         'Last' || o_custkey::VARCHAR AS lastName,
         CASE WHEN o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         o_orderpriority AS location, o_orderstatus AS userAgent
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
),
plays AS (SELECT *, ts // 1000 AS start_time FROM play_log WHERE page = 'NextSong')"""


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("SO"), F.col("p_partkey").cast("string")).alias("song_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("-", F.lit("AR"), F.expr("p_partkey div 64").cast("string"), F.col("p_brand")).alias("artist_id"),
        _artist().alias("artist_name"),
        F.col("p_type").alias("artist_location"),
        F.lit(None).cast("double").alias("artist_latitude"),
        F.lit(None).cast("double").alias("artist_longitude"),
        F.floor("p_retailprice").cast("double").alias("duration"),
        F.when(F.col("p_size") == 1, 0).otherwise(F.col("p_size") + 1970).alias("year"),
    )


CATALOG_SQL = """
catalog AS (
  SELECT 'SO' || p_partkey::VARCHAR AS song_id, p_name AS title,
         'AR-' || (p_partkey // 64)::VARCHAR || '-' || p_brand AS artist_id,
         p_brand || ' / ' || (p_partkey // 64)::VARCHAR AS artist_name,
         p_type AS artist_location, floor(p_retailprice) AS duration,
         CASE WHEN p_size = 1 THEN 0 ELSE p_size + 1970 END AS year
  FROM part
)"""


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    key, person = F.col("o_orderkey"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    days = F.datediff(day, F.lit("1960-01-01").cast("date"))

    def text(c):
        return c.cast("string")

    columns = {
        "cicid": key,
        "admnum": F.when(person % 10 == 0, 0).otherwise(person).cast("double"),
        "i94yr": F.year(day).cast("double"),
        "i94mon": F.month(day).cast("double"),
        "i94cit": F.when(key % 97 != 0, F.col("c_nationkey")).cast("double"),
        "i94res": (person % 27).cast("double"),
        "i94port": F.concat(F.lit("P"), text(person % 1300)),
        "i94addr": F.concat(F.lit("N"), text(key % 30)),
        "arrdate": F.when(key % 1009 == 0, -5).otherwise(days).cast("double"),
        "depdate": F.when(key % 3 == 0, None).when(key % 100 == 1, -1).otherwise(days + 10).cast("double"),
        "dtaddto": F.when(F.col("o_orderpriority") == "5-LOW", "D/S").when(key % 7 == 0, "unknown")
        .otherwise(F.date_format(F.date_add(day, 90), "MMddyyyy")),
        "matflag": F.nullif(F.col("o_orderstatus"), F.lit("O")),
        "i94mode": F.when(key % 13 != 0, F.substring("o_orderpriority", 1, 1)).cast("double"),
        "i94visa": (key % 4 + 1).cast("double"),
        "i94bir": F.when(key % 11 != 0, key % 90).cast("double"),
        "gender": F.nullif(F.substring("c_mktsegment", 1, 1), F.lit("A")),
        "visatype": F.concat(F.substring("c_mktsegment", 1, 1), text(key % 3)),
        "entdepa": F.lit("G"),
        "entdepd": F.when(key % 2 != 0, "O"),
        "entdepu": F.when(key % 50 == 0, "U"),
    }
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(*[c.alias(n) for n, c in columns.items()])


RAW_SQL = """
raw AS (
  SELECT o_orderkey AS cicid,
         CASE WHEN o_custkey % 10 = 0 THEN 0 ELSE o_custkey END::DOUBLE AS admnum,
         year(o_orderdate)::DOUBLE AS i94yr, month(o_orderdate)::DOUBLE AS i94mon,
         CASE WHEN o_orderkey % 97 <> 0 THEN c_nationkey END::DOUBLE AS i94cit,
         (o_custkey % 27)::DOUBLE AS i94res,
         'P' || (o_custkey % 1300)::VARCHAR AS i94port, 'N' || (o_orderkey % 30)::VARCHAR AS i94addr,
         CASE WHEN o_orderkey % 1009 = 0 THEN -5
              ELSE date_diff('day', DATE '1960-01-01', o_orderdate::DATE) END::DOUBLE AS arrdate,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 100 = 1 THEN -1
              ELSE date_diff('day', DATE '1960-01-01', o_orderdate::DATE) + 10 END::DOUBLE AS depdate,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'D/S' WHEN o_orderkey % 7 = 0 THEN 'unknown'
              ELSE strftime(o_orderdate + INTERVAL 90 DAY, '%m%d%Y') END AS dtaddto,
         nullif(o_orderstatus, 'O') AS matflag,
         CASE WHEN o_orderkey % 13 <> 0 THEN substr(o_orderpriority, 1, 1) END::DOUBLE AS i94mode,
         (o_orderkey % 4 + 1)::DOUBLE AS i94visa,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_orderkey % 90 END::DOUBLE AS i94bir,
         nullif(substr(c_mktsegment, 1, 1), 'A') AS gender,
         substr(c_mktsegment, 1, 1) || (o_orderkey % 3)::VARCHAR AS visatype,
         'G' AS entdepa, CASE WHEN o_orderkey % 2 <> 0 THEN 'O' END AS entdepd,
         CASE WHEN o_orderkey % 50 = 0 THEN 'U' END AS entdepu
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

CLEAN_SQL = RAW_SQL + """,
typed AS (
  SELECT cicid, nullif(admnum::BIGINT, 0) AS admnum, i94yr::INTEGER AS year, i94mon::INTEGER AS month,
         CASE WHEN arrdate < 0 THEN DATE '1900-01-01' ELSE DATE '1960-01-01' + arrdate::INTEGER END AS arrival_date,
         CASE WHEN depdate < 0 THEN DATE '1900-01-01' ELSE DATE '1960-01-01' + depdate::INTEGER END AS departure_date,
         try_strptime(dtaddto, '%m%d%Y')::DATE AS permitted_date,
         coalesce(dtaddto = 'D/S', false) AS unrestricted_stay,
         i94cit::INTEGER AS cit, i94res::INTEGER AS res, i94port AS entry_port, i94addr AS destination_state,
         i94bir::INTEGER AS age,
         CASE WHEN gender IS NULL THEN 'UNSPECIFIED' WHEN gender IN ('F', 'M') THEN gender ELSE 'OTHER' END AS gender,
         visatype AS visa_type,
         CASE i94visa::INTEGER WHEN 1 THEN 'Business' WHEN 2 THEN 'Pleasure' WHEN 3 THEN 'Student'
              ELSE CASE WHEN i94visa IS NOT NULL THEN 'Other' END END AS visa_category,
         CASE i94mode::INTEGER WHEN 1 THEN 'Air' WHEN 2 THEN 'Sea' WHEN 3 THEN 'Land'
              ELSE CASE WHEN i94mode IS NOT NULL THEN 'Other' END END AS travel_mode,
         matflag IS NOT NULL AS dates_match_flag, entdepd, entdepu
  FROM raw
),
clean AS (
  SELECT *, day(arrival_date)::INTEGER AS day,
         NOT dates_match_flag AND NOT unrestricted_stay AND departure_date IS NULL
           AND entdepd IS NULL AND entdepu IS NULL AS is_overstay,
         count(admnum) OVER earlier AS num_previous_stays, count(*) OVER earlier AS num_previous_any
  FROM typed
  WINDOW earlier AS (PARTITION BY admnum ORDER BY arrival_date, cicid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)"""


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    padded = F.lpad(F.col("n_nationkey").cast("string"), 2, "0")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("country_id"),
        F.concat(F.lit("C"), padded).alias("country_code"),
        F.concat(F.lit("K"), padded).alias("country_code_iso_2"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("continent"),
    )


COUNTRIES_SQL = """
countries AS (
  SELECT n_nationkey AS country_id, 'C' || lpad(n_nationkey::VARCHAR, 2, '0') AS country_code,
         'K' || lpad(n_nationkey::VARCHAR, 2, '0') AS country_code_iso_2, n_name AS country_name, r_name AS continent
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def yearly_gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A figure per nation and year: the year's order total, in cents.

    Some nations report under a foreign code, so that lookups miss.
    """
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    # totals per customer and year first: that is what meets the customer table
    per_customer = orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum(cents).alias("cents"))
    return (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", "year").agg(F.sum("cents").alias("gdp_value"))
        .select(
            F.concat(
                F.when(F.col("c_nationkey") < 20, "C").otherwise("X"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")
            ).alias("country_code"),
            "year",
            "gdp_value",
        )
    )


GDP_SQL = """
gdp AS (
  SELECT country_code, arg_max(gdp_value, year) AS gdp_value FROM (
    SELECT CASE WHEN c_nationkey < 20 THEN 'C' ELSE 'X' END || lpad(c_nationkey::VARCHAR, 2, '0') AS country_code,
           year(o_orderdate) AS year, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS gdp_value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
  GROUP BY country_code
)"""


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    known = countries(spark, sf_dir)
    return Dimensions(
        countries=known.select("country_id", "country_code", "country_name"),
        iso=known.select("country_code", "country_name", "country_code_iso_2", "continent"),
        gdp=latest_gdp(yearly_gdp(spark, sf_dir)),
        states=nation.select(
            F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_code"), F.col("n_name").alias("state_name")
        ),
        ports=supplier.select(
            F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("port_id"),
            F.concat(F.lit(" "), F.col("s_name"), F.lit("  ")).alias("port_name"),
        ),
    )


FACT_SQL = CLEAN_SQL + "," + COUNTRIES_SQL + """,
fact AS (
  SELECT coalesce(admnum, 0) AS admnum, cicid, year, month, day, arrival_date, departure_date, permitted_date,
         unrestricted_stay, c.country_code AS country_citizenship, r.country_code AS country_residence,
         trim(s_name) AS port_name, 'N' || n_nationkey::VARCHAR AS destination_state, age, gender, num_previous_stays,
         visa_type, visa_category, is_overstay
  FROM clean
  JOIN countries c ON cit = c.country_id
  JOIN countries r ON res = r.country_id
  LEFT JOIN nation ON destination_state = 'N' || n_nationkey::VARCHAR
  LEFT JOIN supplier ON entry_port = 'P' || s_suppkey::VARCHAR
)"""
