"""The same views and queries in SQL, written apart from the DataFrame code."""

# The stand-in views of `lakeops.plans.standins`.
VIEWS = {
    "sales": """
        SELECT l_orderkey AS order_id, l_extendedprice AS sales_price, o_orderdate AS "timestamp",
               CASE WHEN l_linenumber % 4 <> 0 THEN o_orderpriority END AS payment_method,
               p_type AS category, n_name AS city
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "products": """
        SELECT p_partkey,
               concat('brand_', substr(p_brand, 7),
                      CASE p_partkey % 3 WHEN 0 THEN ' - ' WHEN 1 THEN ', ' ELSE '   ' END,
                      p_name, ' 20-10-10') AS product
        FROM part""",
    "logistics": """
        SELECT *, CASE WHEN state = 'F' AND order_id % 11 <> 0
                       THEN scheduled_delivery_date + CAST(late AS INTEGER)
                  END AS actual_delivery_date
        FROM (SELECT o_orderkey AS order_id, o_orderstatus AS state,
                     CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS "timestamp",
                     36.25::DOUBLE + o_orderkey % 7 AS lat, -0.5::DOUBLE - o_orderkey % 3 AS lon,
                     CAST(o_orderdate AS DATE) AS pickup_date,
                     CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 AS INTEGER)
                       AS scheduled_delivery_date,
                     CASE o_orderstatus WHEN 'F' THEN 'received' WHEN 'O' THEN 'sent'
                       ELSE 'pending' END AS shipment_status,
                     CASE WHEN o_orderkey % 5 = 0 THEN 1 + o_orderkey % 4 ELSE 0 END AS late
              FROM orders)""",
    "readings": """
        SELECT event_id, user_id AS station_id, epoch_us(ts) // 1000000 AS sec,
               CASE WHEN event_id % 10 <> 0 THEN value END AS temperature_C
        FROM events""",
    "daily": """
        SELECT CAST(l_shipdate AS DATE) AS date, l_quantity AS temperature_C,
               l_discount AS humidity_percent
        FROM lineitem""",
    "inventory": """
        SELECT *, upper(regexp_extract(plain, '([a-zA-Z]+_\\d+)', 1)) AS product_id,
               upper(trim(regexp_replace(plain, '([a-zA-Z]+_\\d+)', '', 'g'))) AS product_name
        FROM (SELECT l_orderkey, l_linenumber,
                     CASE WHEN l_orderkey % 17 <> 0 THEN l_shipdate END AS "timestamp",
                     lower(l_returnflag) AS category,
                     regexp_replace(CASE WHEN l_partkey % 50 = 0 THEN NULL
                       WHEN l_partkey % 51 = 0 THEN 'no id here'
                       ELSE 'p_' || l_partkey || ' - Part, 20-10-10' END, '[,-]', '', 'g') AS plain,
                     CASE WHEN (l_orderkey + l_linenumber) % 7 <> 0 THEN l_quantity END
                       AS stock_quantity,
                     CASE WHEN (l_orderkey + l_linenumber) % 9 <> 0 THEN l_extendedprice END
                       AS sales_price,
                     CAST(l_shipdate AS DATE) AS manufacturing_date,
                     CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_shipdate AS DATE) + 30 END
                       AS expiration_date
              FROM lineitem)""",
    "inventory_means": """
        SELECT product_id AS mean_id,
               CAST(sum(CAST(stock_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(stock_quantity)
                 AS stock_mean,
               CAST(sum(CAST(sales_price AS DECIMAL(18,2))) AS DOUBLE) / count(sales_price)
                 AS price_mean
        FROM inventory GROUP BY product_id""",
    "silver_sales": """
        SELECT order_id, transaction_id, sales_price, coalesce(currency, 'EUR') AS currency,
               coalesce(upper(payment_method), 'CREDIT_CARD') AS payment_method,
               upper(transaction_status) AS transaction_status, upper(city) AS city,
               upper(trim(regexp_replace(plain_address, '\\b(\\d{5})\\b', '', 'g'))) AS address,
               TRY_CAST(regexp_extract(plain_address, '\\b(\\d{5})\\b', 1) AS INTEGER)
                 AS postal_code,
               upper(category) AS category, latitude, longitude,
               upper(regexp_extract(plain, '([a-zA-Z]+_\\d+)', 1)) AS product_id,
               upper(trim(regexp_replace(plain, '([a-zA-Z]+_\\d+)', '', 'g'))) AS product_name,
               "timestamp", CAST(year("timestamp") AS INTEGER) AS year,
               CAST(month("timestamp") AS INTEGER) AS month,
               CAST(day("timestamp") AS INTEGER) AS day
        FROM (SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
                     concat('t-', l_orderkey, '-', l_linenumber) AS transaction_id,
                     l_extendedprice AS sales_price,
                     CASE WHEN l_linenumber % 3 <> 0 THEN 'USD' END AS currency,
                     CASE WHEN l_linenumber % 4 <> 0 THEN lower(o_orderpriority) END
                       AS payment_method,
                     lower(o_orderstatus) AS transaction_status,
                     36.25::DOUBLE + l_suppkey % 7 AS latitude,
                     CASE WHEN l_suppkey % 2 = 0 THEN 1 ELSE -1 END * (0.5::DOUBLE + l_suppkey % 13)
                       AS longitude,
                     lower(n_name) AS city,
                     regexp_replace(concat('Calle Mayor, ', o_custkey,
                       CASE WHEN o_custkey % 4 = 0 THEN ''
                       ELSE concat(', ', lpad(CAST(o_custkey % 52000 + 1000 AS VARCHAR), 5, '0'))
                       END), ',', '', 'g') AS plain_address,
                     lower(p_type) AS category,
                     regexp_replace(product, '[,-]', '', 'g') AS plain,
                     CASE WHEN l_orderkey % 11 <> 0 THEN o_orderdate
                       ELSE TIMESTAMP '2030-01-01 00:00:00' END AS "timestamp"
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
              JOIN part ON l_partkey = part.p_partkey
              JOIN products ON products.p_partkey = part.p_partkey
              JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
}

RANGE_MEAN = """coalesce({field}, CAST(round(CAST(
    CAST(sum(CAST({field} AS DECIMAL(18,2))) OVER w AS DOUBLE) / count({field}) OVER w
    AS DECIMAL(18,9)), 3) AS DOUBLE)) AS {field}"""


def _window(key: str, hours: int) -> str:
    return (
        f"WINDOW w AS (PARTITION BY {key} ORDER BY sec "
        f"RANGE BETWEEN {hours * 3600} PRECEDING AND CURRENT ROW)"
    )


def _with(views: str, query: str) -> str:
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in views.split())
    return f"WITH {ctes}\n{query}"


_FULFILMENT = """
    SELECT category, city, count(*) AS total_orders,
           CAST(sum(CASE WHEN delay <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_deliveries,
           avg(delay) AS avg_delay_days,
           CAST(sum(CASE WHEN delay <= 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS on_time_rate
    FROM sales JOIN (SELECT order_id,
      date_diff('day', scheduled_delivery_date, actual_delivery_date) AS delay FROM logistics)
      USING (order_id)
    GROUP BY category, city"""

_VOLUME = """
    SELECT category, CAST("timestamp" AS DATE) AS order_date, count(*) AS orders_count,
           CAST(sum(CAST(sales_price AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
           CAST(sum(CAST(sales_price AS DECIMAL(18,2))) AS DOUBLE) / count(sales_price)
             AS avg_order_value
    FROM {sales} GROUP BY ALL"""

_WEATHER = """
    CAST(sum(CAST(temperature_C AS DECIMAL(18,2))) AS DOUBLE) / count(temperature_C) AS avg_temp_C,
    CAST(sum(CAST(humidity_percent AS DECIMAL(18,2))) AS DOUBLE) / count(humidity_percent)
      AS avg_humidity"""

_SILVER_READINGS = """
    SELECT event_id, {key}, {fields}, event_time AS "timestamp",
           CAST(year(event_time) AS INTEGER) AS year, CAST(month(event_time) AS INTEGER) AS month,
           CAST(day(event_time) AS INTEGER) AS day{more}
    FROM (SELECT *, epoch_us(event_time) // 1000000 AS sec FROM ({rows}))
    {window}"""

_IMPUTED_INVENTORY = """
    FROM inventory LEFT JOIN inventory_means ON product_id = mean_id"""

ORACLE: dict[str, str] = {
    "sales_volume": _with("sales", _VOLUME.format(sales="sales")),
    "order_fulfillment_performance": _with("sales logistics", _FULFILMENT),
    "climate_impact": _with(
        "sales daily",
        f"""
        SELECT date, total_sales, avg_temp_C, avg_humidity
        FROM (SELECT CAST("timestamp" AS DATE) AS date,
                     CAST(sum(CAST(sales_price AS DECIMAL(18,2))) AS DOUBLE) AS total_sales
              FROM sales GROUP BY 1)
        JOIN (SELECT date, {_WEATHER} FROM daily GROUP BY 1) USING (date)""",
    ),
    # Repeating the readings changes no mean; the means are taken before the join so that
    # both sides divide the same numbers.
    "climate_impact_as_coded": _with(
        "sales daily",
        f"""
        SELECT date, CAST(sum(CAST(sales_price AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
               any_value(avg_temp_C) AS avg_temp_C, any_value(avg_humidity) AS avg_humidity
        FROM (SELECT CAST("timestamp" AS DATE) AS date, sales_price FROM sales)
        JOIN daily USING (date)
        JOIN (SELECT date, {_WEATHER} FROM daily GROUP BY 1) USING (date)
        GROUP BY date""",
    ),
    "delivery_delay": _with(
        "logistics",
        """
        SELECT order_id, CAST(delay AS INTEGER) AS delivery_delay_days,
               coalesce(delay <= 0, false) AS on_time_delivery
        FROM (SELECT order_id,
          date_diff('day', scheduled_delivery_date, actual_delivery_date) AS delay
          FROM logistics)""",
    ),
    "moving_average": _with(
        "readings",
        f"""
        SELECT event_id, station_id,
               CAST(sum(CAST(temperature_C AS DECIMAL(18,2))) OVER w AS DOUBLE)
                 / count(temperature_C) OVER w AS mean_last_72h
        FROM readings {_window("station_id", 72)}""",
    ),
    "mean_by_key": _with(
        "inventory inventory_means",
        "SELECT mean_id AS product_id, stock_mean AS stock_quantity_mean FROM inventory_means",
    ),
    "impute_mean_by_key": _with(
        "inventory inventory_means",
        f"""
        SELECT l_orderkey, l_linenumber, product_id,
               coalesce(stock_quantity, stock_mean) AS stock_quantity,
               coalesce(sales_price, price_mean) AS sales_price
        {_IMPUTED_INVENTORY}""",
    ),
    "impute_date_offset": _with(
        "inventory",
        """
        SELECT l_orderkey, l_linenumber,
               coalesce(expiration_date, manufacturing_date + 40) AS expiration_date
        FROM inventory""",
    ),
    "impute_literal": _with(
        "sales",
        """
        SELECT order_id, sales_price, coalesce(payment_method, 'CREDIT_CARD') AS payment_method
        FROM sales""",
    ),
    "impute_from_column": _with(
        "logistics",
        """
        SELECT order_id, upper(shipment_status) AS shipment_status,
               CASE WHEN actual_delivery_date IS NULL AND upper(shipment_status) = 'RECEIVED'
                    THEN scheduled_delivery_date ELSE actual_delivery_date
               END AS actual_delivery_date
        FROM logistics""",
    ),
    "default_timestamp": """
        SELECT event_id, CASE WHEN event_id % 89 = 0 THEN TIMESTAMP '2030-01-01 00:00:00'
                              ELSE ts END AS "timestamp"
        FROM events""",
    "partition_columns": """
        SELECT event_id, ts, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day
        FROM events""",
    "uppercase": "SELECT p_partkey, upper(p_name) AS p_name, upper(p_type) AS p_type FROM part",
    "split_product": _with(
        "products",
        """
        SELECT p_partkey, upper(regexp_extract(plain, '([a-zA-Z]+_\\d+)', 1)) AS product_id,
               upper(trim(regexp_replace(plain, '([a-zA-Z]+_\\d+)', '', 'g'))) AS product_name
        FROM (SELECT p_partkey, regexp_replace(product, '[,-]', '', 'g') AS plain FROM products)""",
    ),
    "split_coord_string": """
        SELECT s_suppkey, 36.25::DOUBLE + s_suppkey % 7 AS latitude,
               CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE -1 END * (0.5::DOUBLE + s_suppkey % 13)
                 AS longitude
        FROM supplier""",
    "split_coord_string_as_coded": """
        SELECT s_suppkey,
               TRY_CAST(regexp_extract(coord, '(\\d+\\.\\d+).+(\\d+\\.\\d+)', 1) AS DOUBLE)
                 AS latitude,
               TRY_CAST(regexp_extract(coord, '(\\d+\\.\\d+).+(\\d+\\.\\d+)', 2) AS DOUBLE)
                 AS longitude
        FROM (SELECT s_suppkey, concat('(', 36 + s_suppkey % 7, '.25, ',
                CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '-' END, s_suppkey % 13, '.5)') AS coord
              FROM supplier)""",
    "split_coord_array": """
        SELECT event_id, CAST(40 + user_id % 3 AS DOUBLE) AS latitude,
               CAST(-3 - user_id % 2 AS DOUBLE) AS longitude
        FROM events""",
    "split_coord_array_uncast": """
        SELECT event_id, 40 + user_id % 3 AS latitude, -3 - user_id % 2 AS longitude FROM events""",
    "split_address": """
        SELECT c_custkey, trim(regexp_replace(plain, '\\b(\\d{5})\\b', '', 'g')) AS address,
               TRY_CAST(regexp_extract(plain, '\\b(\\d{5})\\b', 1) AS INTEGER) AS postal_code
        FROM (SELECT c_custkey, regexp_replace(concat('Calle Mayor, ', c_custkey,
                CASE WHEN c_custkey % 4 = 0 THEN ''
                ELSE concat(', ', lpad(CAST(c_custkey % 52000 + 1000 AS VARCHAR), 5, '0')) END),
                ',', '', 'g') AS plain
              FROM customer)""",
    "epoch_millis": """
        SELECT event_id, CASE WHEN event_id % 97 <> 0
               THEN make_timestamp(epoch_us(ts) // 1000000 * 1000000) END AS event_time
        FROM events""",
    "decode_json_value": """
        SELECT 'events' AS _topic, 0 AS _partition, event_id AS _offset, ts AS _timestamp,
               0 AS "_timestampType", CAST(user_id AS VARCHAR) AS key,
               CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               CAST(NULL AS VARCHAR) AS missing
        FROM events""",
    "strip_frame": "SELECT event_id, hex(encode(event_type)) AS payload FROM events",
    "rescue_json": """
        SELECT event_id, CASE WHEN event_id % 3 <> 1 THEN CAST(n AS INTEGER) END AS k,
               CASE event_id % 3 WHEN 1 THEN concat('{"k":"x', n, '"}')
                    WHEN 2 THEN concat('{"new":"', event_type, '"}') END AS _rescued_data
        FROM (SELECT *, json_extract_string(props, '$.k') AS n FROM events)""",
    "rescue_texts": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date,
               CASE WHEN o_orderkey % 20 = 0
                      THEN concat('{"order_date":"unknown","remark":"', o_orderpriority, '"}')
                    WHEN o_orderkey % 4 = 0 THEN '{"order_date":"unknown"}'
                    WHEN o_orderkey % 5 = 0 THEN concat('{"remark":"', o_orderpriority, '"}')
               END AS _rescued_data
        FROM orders""",
    "incremental_scan": """
        SELECT event_id, event_type, ts AS _ingestion_time FROM events
        WHERE ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-20 12:00:00'""",
    "high_mark": """
        SELECT max(ts) AS high_mark FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'""",
    "partitioned_append": """
        SELECT event_id, event_type, value, CAST(year(ts) AS INTEGER) AS year,
               CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
        FROM events WHERE ts >= DATE '2024-01-03' AND ts < DATE '2024-01-24'""",
    "ingest_csv": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
               CAST(NULL AS VARCHAR) AS _rescued_data, true AS _ingested_filename,
               true AS _ingestion_time
        FROM orders""",
    "ingest_json": """
        SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS _rescued_data,
               true AS _ingested_filename, true AS _ingestion_time
        FROM events""",
    "ingest_parquet": """
        SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate),
               CAST(NULL AS VARCHAR) AS _rescued_data, true AS _ingested_filename,
               true AS _ingestion_time
        FROM lineitem""",
    "ingest_parquet_types": """
        SELECT l_orderkey,
               CASE WHEN l_orderkey % 5 <> 0 OR l_linenumber <> 1
                 THEN CAST(l_linenumber AS INTEGER) END AS l_linenumber,
               l_returnflag,
               CASE WHEN l_orderkey % 5 = 0 AND l_linenumber = 1
                 THEN '{"l_linenumber":"line 1"}' END AS _rescued_data,
               true AS _ingested_filename, true AS _ingestion_time
        FROM lineitem""",
    "ingest_binary_files": """
        SELECT CAST(sum(strlen(html) + 1) AS BIGINT) AS total_bytes,
               CAST(sum(strlen(html) + 1) AS BIGINT) AS content_bytes
        FROM pages""",
    "silver_climate": _SILVER_READINGS.format(
        key="station_id",
        fields=", ".join(
            RANGE_MEAN.format(field=f)
            for f in (
                "temperature_C",
                "humidity_percent",
                "precipitation_mm",
                "solar_radiation_Wm2",
                "wind_speed_mps",
            )
        ),
        more=""", CAST(40 + station_id % 3 AS DOUBLE) AS latitude,
           CAST(-3 - station_id % 2 AS DOUBLE) AS longitude""",
        rows="""
            SELECT event_id, user_id AS station_id,
                   CASE WHEN event_id % 97 <> 0
                     THEN make_timestamp(epoch_us(ts) // 1000000 * 1000000) END AS event_time,
                   CASE WHEN event_id % 10 <> 0 THEN value END AS temperature_C,
                   CASE WHEN event_id % 7 <> 0 THEN value + 1 END AS humidity_percent,
                   CASE WHEN event_id % 5 <> 0 THEN value + 2 END AS precipitation_mm,
                   CASE WHEN event_id % 3 <> 0 THEN value + 3 END AS solar_radiation_Wm2,
                   CASE WHEN event_id % 2 <> 0 THEN value + 4 END AS wind_speed_mps
            FROM events""",
        window=_window("station_id", 3),
    ),
    "silver_iot_sensors": _SILVER_READINGS.format(
        key="key",
        fields=", ".join(
            RANGE_MEAN.format(field=f)
            for f in ("soil_temperature", "soil_humidity", "soil_quality")
        ),
        more="",
        rows="""
            SELECT event_id, CAST(user_id AS VARCHAR) AS key,
                   CASE WHEN event_id % 89 = 0 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE ts END
                     AS event_time,
                   CASE WHEN event_id % 10 <> 0 THEN value END AS soil_temperature,
                   CASE WHEN event_id % 3 <> 0 THEN value + 1 END AS soil_humidity,
                   CASE WHEN event_id % 2 <> 0 THEN value + 2 END AS soil_quality
            FROM events""",
        window=_window("key", 2),
    ),
    "silver_inventory": _with(
        "inventory inventory_means",
        f"""
        SELECT l_orderkey, l_linenumber, event_time AS "timestamp", upper(category) AS category,
               coalesce(stock_quantity, stock_mean) AS stock_quantity,
               coalesce(sales_price, price_mean) AS sales_price, manufacturing_date,
               coalesce(expiration_date, manufacturing_date + 40) AS expiration_date,
               CAST(year(event_time) AS INTEGER) AS year,
               CAST(month(event_time) AS INTEGER) AS month,
               CAST(day(event_time) AS INTEGER) AS day, product_id, product_name
        FROM (SELECT *, coalesce("timestamp", TIMESTAMP '2030-01-01 00:00:00') AS event_time
              {_IMPUTED_INVENTORY})""",
    ),
    "silver_logistics": _with(
        "logistics",
        """
        SELECT order_id, event_time AS "timestamp", pickup_date, scheduled_delivery_date,
               upper(shipment_status) AS shipment_status,
               CASE WHEN actual_delivery_date IS NULL AND upper(shipment_status) = 'RECEIVED'
                    THEN scheduled_delivery_date ELSE actual_delivery_date
               END AS actual_delivery_date,
               CAST(year(event_time) AS INTEGER) AS year,
               CAST(month(event_time) AS INTEGER) AS month,
               CAST(day(event_time) AS INTEGER) AS day, lat AS latitude, lon AS longitude
        FROM (SELECT *, coalesce("timestamp", TIMESTAMP '2030-01-01 00:00:00') AS event_time
              FROM logistics)""",
    ),
    "silver_online_sales": _with("products silver_sales", "SELECT * FROM silver_sales"),
    "bronze_to_gold_sales": _with("products silver_sales", _VOLUME.format(sales="silver_sales")),
    "lakehouse_sales_volume": """
        SELECT upper(event_type) AS category, CAST(day AS DATE) AS order_date,
               count(*) AS orders_count,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
               CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(value), 0)
                 AS avg_order_value
        FROM (SELECT *, CASE WHEN event_id % 11 <> 0 THEN ts
                             ELSE TIMESTAMP '2030-01-01 00:00:00' END AS day
              FROM events)
        GROUP BY ALL""",
}
ORACLE |= {
    "lakehouse_two_runs": ORACLE["lakehouse_sales_volume"],
    "lakehouse_climate": ORACLE["silver_climate"],
    "lakehouse_logistics": ORACLE["silver_logistics"],
    "lakehouse_inventory": ORACLE["silver_inventory"],
    "lakehouse_iot_sensors": ORACLE["silver_iot_sensors"],
    "lakehouse_packed_runs": ORACLE["lakehouse_sales_volume"],
    "lakehouse_images": ORACLE["ingest_binary_files"],
    "lakehouse_climate_impact": f"""
        WITH weather AS (
          SELECT CAST("timestamp" AS DATE) AS date,
                 CAST(sum(CAST(temperature_C AS DECIMAL(18,2))) AS DOUBLE) / nullif(count(temperature_C), 0)
                   AS avg_temp_C,
                 CAST(sum(CAST(humidity_percent AS DECIMAL(18,2))) AS DOUBLE)
                   / nullif(count(humidity_percent), 0) AS avg_humidity
          FROM ({ORACLE["silver_climate"]}) GROUP BY ALL
        )
        SELECT date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_sales, avg_temp_C, avg_humidity
        FROM (SELECT value, CAST(CASE WHEN event_id % 11 <> 0 THEN ts ELSE TIMESTAMP '2030-01-01 00:00:00' END
                                 AS DATE) AS date FROM events)
        JOIN weather USING (date) GROUP BY ALL""",
    "ingest_rejects": """
        SELECT event_id AS _offset, CASE event_id % 10 WHEN 0 THEN 265::BIGINT END AS _schema_id,
               concat(CASE event_id % 10 WHEN 0 THEN '0000000109' ELSE '' END,
                      hex(encode(CAST(user_id AS VARCHAR)))) AS value
        FROM events WHERE event_id % 10 < 2""",
    "lakehouse_fulfillment": _with(
        "logistics",
        """
        SELECT upper(event_type) AS category, 'CITY' AS city, count(*) AS total_orders,
               CAST(sum(CASE WHEN delay <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS on_time_deliveries,
               avg(delay) AS avg_delay_days,
               CAST(sum(CASE WHEN delay <= 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS on_time_rate
        FROM events JOIN (SELECT order_id, date_diff('day', scheduled_delivery_date,
            CASE WHEN actual_delivery_date IS NULL AND upper(shipment_status) = 'RECEIVED'
                 THEN scheduled_delivery_date ELSE actual_delivery_date END) AS delay FROM logistics)
          ON event_id = order_id
        GROUP BY event_type""",
    ),
    "lakehouse_client_data": """
        SELECT event_id AS _offset, CAST(user_id AS VARCHAR) AS key,
               CASE WHEN good THEN concat('user ', user_id) END AS full_name,
               CASE WHEN good THEN CAST(user_id % 80 AS INTEGER) END AS age,
               CASE WHEN good THEN value END AS engagement_score,
               CASE WHEN good THEN date_trunc('millisecond', ts) END AS "timestamp",
               CASE WHEN good THEN concat(event_type, ',x') END AS items
        FROM (SELECT *, event_id % 10 <> 0 AS good FROM events)""",
    "split_by_schema": """
        SELECT event_id, event_id % 3 <> 0 AS rejected,
               concat(CASE event_id % 3 WHEN 1 THEN '0000000107' ELSE '' END, hex(encode(event_type)))
                 AS payload
        FROM events""",
    "ingest_misfits": """
        SELECT CASE WHEN k <> 3 THEN event_id END AS id, CASE WHEN k = 0 THEN event_id END AS a,
               CASE WHEN k = 2 THEN 1::BIGINT END AS first,
               CASE k WHEN 1 THEN '{"s":"{\\"a\\":\\"x\\"}"}'
                      WHEN 2 THEN concat('{"l":"[{\\"a\\":1,\\"z\\":', event_id, '}]"}')
                      WHEN 3 THEN concat('{"id":"x', event_id, '"}') END AS _rescued_data
        FROM (SELECT event_id, event_id % 4 AS k FROM events)""",
    "ingest_binary_content": """
        SELECT md5(line) AS line_md5
        FROM (SELECT unnest(string_split(html, chr(10))) AS line FROM pages)""",
    "widened_append": """
        SELECT event_id, CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type, value,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
               CAST(day(ts) AS INTEGER) AS day
        FROM events""",
}
for _name in ("impute_window_null", "impute_window_nan"):
    ORACLE[_name] = _with(
        "readings",
        f"""
        SELECT event_id, station_id, {RANGE_MEAN.format(field="temperature_C")}
        FROM readings {_window("station_id", 72)}""",
    )
