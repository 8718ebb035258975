"""Independent DuckDB SQL for every registered query (the correctness oracle).

The source derivations mirror :mod:`starloom.plans.testdata`; everything after them is written
directly in SQL from the pipeline's semantics (QUALIFY windows for "first"/"last", CASE for
lenient parsing, joins for lookups). Nothing is taken from the code under test but the day that
separates two loads.
"""

from __future__ import annotations

from starloom.plans.testdata import FIRST_LOAD_BEFORE

# Fixed values, written here a second time on purpose: what a CSV reader takes for missing, and the
# catalog label of each product category (any other: electronics).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
LABELS = {
    "eletronicos": "electronics",
    "informatica_acessorios": "electronics",
    "telefonia": "electronics",
    "tablets_impressao_imagem": "electronics",
    "audio": "electronics",
    "eletrodomesticos": "electronics",
    "eletrodomesticos_2": "electronics",
    "utilidades_domesticas": "electronics",
    "cama_mesa_banho": "women's clothing",
    "fashion_bolsas_e_acessorios": "women's clothing",
    "fashion_roupa_feminina": "women's clothing",
    "fashion_roupa_masculina": "men's clothing",
    "fashion_calcados": "men's clothing",
    "fashion_underwear_e_moda_praia": "men's clothing",
    "fashion_esporte": "men's clothing",
    "joias_relogios": "jewelery",
    "relogios_presentes": "jewelery",
    "bijuterias_e_jóias": "jewelery",
}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


NA_LIST = "(" + ", ".join(q(t) for t in NA_TOKENS) + ")"
VALID = "('F', 'O')"
RUN1 = "TIMESTAMP '2024-01-01 00:00:00'"
RUN2 = "TIMESTAMP '2024-01-02 00:00:00'"


def na(c: str) -> str:
    return f"CASE WHEN {c} IN {NA_LIST} THEN NULL ELSE {c} END"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def title(x: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({x}, '(\\p{{L}}+|[^\\p{{L}}]+)', 1), "
        "lambda r: upper(r[1]) || lower(r[2:])), '')"
    )


def zfill5(z: str) -> str:
    return (
        f"CASE WHEN length({z}) >= 5 THEN {z} "
        f"WHEN {z} LIKE '-%' OR {z} LIKE '+%' THEN substr({z}, 1, 1) || lpad(substr({z}, 2), 4, '0') "
        f"ELSE lpad({z}, 5, '0') END"
    )


def num(x: str) -> str:
    return f"CASE WHEN isnan(try_cast({x} AS DOUBLE)) THEN NULL ELSE try_cast({x} AS DOUBLE) END"


def seq(x: str) -> str:
    return f"COALESCE(try_cast(trunc({num(x)}) AS BIGINT), 1)"


TS_FORMATS = (
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%n",
    "%Y-%m-%d",
    "%Y/%m/%d %H:%M:%S",
    "%m/%d/%Y",
    "%Y-%m-%dT%H:%M:%S.%g",
    "%Y-%m-%dT%H:%M:%SZ",
)


def parsed(x: str, fmt: str) -> str:
    """Cut to the microsecond; a format with nanoseconds gives another type, whose cast would round."""
    time = f"try_strptime({x}, '{fmt}')"
    return f"make_timestamp(epoch_ns({time}) // 1000)" if fmt.endswith("%n") else time


def ts(x: str) -> str:
    s = strip(x)
    return "COALESCE(" + ", ".join(parsed(s, f) for f in TS_FORMATS) + ")"


# What a value looks like in each format above, in the same order.
_DAY, _CLOCK = r"\d{4}-\d{1,2}-\d{1,2}", r"\d{1,2}:\d{2}:\d{2}"
TS_SHAPES = (
    rf"{_DAY} {_CLOCK}",
    rf"{_DAY}T{_CLOCK}",
    rf"{_DAY} {_CLOCK}\.\d{{1,9}}",
    _DAY,
    rf"\d{{4}}/\d{{1,2}}/\d{{1,2}} {_CLOCK}",
    r"\d{1,2}/\d{1,2}/\d{4}",
    rf"{_DAY}T{_CLOCK}\.\d{{1,9}}",
    rf"{_DAY}T{_CLOCK}Z",
)


def inferred(x: str, first: str) -> str:
    """``x`` in the format that the column's first value ``first`` has; by itself where that has none."""
    whens = []
    for fmt, shape in zip(TS_FORMATS, TS_SHAPES):
        for lead in ("", r"\s+"):
            own = q(lead + shape)
            whens.append(f"WHEN regexp_full_match({first}, {own}) THEN CASE WHEN regexp_full_match({x}, {own}) THEN {parsed(strip(x), fmt)} END")
    return f"CASE {' '.join(whens)} ELSE {ts(x)} END"


def category_label(c: str) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(label)}" for k, label in LABELS.items())
    return f"COALESCE(CASE {c} {whens} END, 'electronics')"


EARLY = f"(SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{FIRST_LOAD_BEFORE} 00:00:00')"

CTES: list[tuple[str, str]] = [
    (
        "raw_customers",
        f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
  CASE WHEN c_custkey % 97 = 13 THEN 'NA'
       WHEN c_custkey % 10 = 9 THEN CAST(c_custkey - 1 AS VARCHAR)
       ELSE CAST(c_custkey AS VARCHAR) END AS customer_unique_id,
  CASE WHEN c_custkey % 31 = 0 THEN 'N/A'
       WHEN c_custkey % 4 = 0 THEN '  ' || lower(c_mktsegment) || ' city' || chr(9)
       WHEN c_custkey % 4 = 1 THEN lower(c_mktsegment) || '-' || lower(c_name)
       WHEN c_custkey % 4 = 2 THEN 'santa ' || lower(c_mktsegment) || ' d''oeste'
       ELSE upper(c_mktsegment) || ' embu-guaçu' END AS customer_city,
  CASE WHEN c_custkey % 23 = 0 THEN '' ELSE ' ' || lower(substr(c_mktsegment, 1, 2)) || ' ' END AS customer_state,
  CASE WHEN c_custkey % 29 = 0 THEN 'null'
       WHEN c_custkey % 11 = 0 THEN CAST(c_custkey * 1000 + 123456 AS VARCHAR)
       WHEN c_acctbal < 0 THEN '-' || CAST(c_nationkey AS VARCHAR)
       ELSE CAST(c_nationkey * 100 + c_custkey % 100 AS VARCHAR) END AS customer_zip_code_prefix,
  c_custkey AS _ord
FROM customer""",
    ),
    (
        "c_n",
        f"""SELECT {na('customer_id')} AS customer_id, {na('customer_unique_id')} AS customer_unique_id,
  {na('customer_city')} AS customer_city, {na('customer_state')} AS customer_state,
  {na('customer_zip_code_prefix')} AS customer_zip_code_prefix, _ord FROM raw_customers""",
    ),
    (
        "customers_clean",
        f"""SELECT customer_id, customer_unique_id,
  COALESCE({title(strip('customer_city'))}, 'Unknown') AS city,
  COALESCE(upper({strip('customer_state')}), 'XX') AS state,
  COALESCE({zfill5(strip('customer_zip_code_prefix'))}, '00000') AS zip_code,
  _ord
FROM c_n WHERE customer_id IS NOT NULL AND customer_unique_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY _ord) = 1""",
    ),
    (
        "raw_orders",
        """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
  CASE WHEN o_orderkey % 211 = 5 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN o_orderkey % 199 = 7 THEN 'null' ELSE o_orderstatus END AS order_status,
  CASE WHEN o_orderkey % 101 = 3 THEN 'not a date'
       WHEN o_orderkey % 103 = 4 THEN 'NaN'
       WHEN o_orderkey % 11 = 2 THEN strftime(_t, '%Y/%m/%d %H:%M:%S')
       WHEN o_orderkey % 11 = 3 THEN strftime(_t, '%m/%d/%Y')
       WHEN o_orderkey % 11 = 4 THEN strftime(_t, '%Y-%m-%dT%H:%M:%S') || '.123'
       WHEN o_orderkey % 11 = 5 THEN strftime(_t, '%Y-%m-%dT%H:%M:%S') || 'Z'
       WHEN o_orderkey % 11 = 6 THEN strftime(_t, '%Y-%m-%d %H:%M:%S') || '.123456789'
       WHEN o_orderkey % 5 = 0 THEN strftime(_t, '%Y-%m-%d')
       WHEN o_orderkey % 5 = 1 THEN strftime(_t, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(_t, '%Y-%m-%d %H:%M:%S') END AS order_purchase_timestamp,
  ' ' || strftime(o_orderdate + INTERVAL 14 DAY, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date,
  o_orderpriority,
  o_orderkey AS _ord
FROM (SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS _t FROM orders)""",
    ),
    (
        "o_n",
        f"""SELECT {na('order_id')} AS order_id, {na('customer_id')} AS customer_id,
  {na('order_status')} AS order_status, {na('order_purchase_timestamp')} AS order_purchase_timestamp,
  {na('order_estimated_delivery_date')} AS order_estimated_delivery_date,
  {na('o_orderpriority')} AS o_orderpriority, _ord FROM raw_orders""",
    ),
    (
        "o_parsed",
        f"""SELECT order_id, customer_id, order_status,
  {ts('order_purchase_timestamp')} AS purchase_ts,
  {ts('order_estimated_delivery_date')} AS estimated_ts, _ord FROM o_n""",
    ),
    ("o_keys", "SELECT * FROM o_parsed WHERE order_id IS NOT NULL AND customer_id IS NOT NULL"),
    ("o_valid", f"SELECT * FROM o_keys WHERE order_status IN {VALID}"),
    (
        "raw_items",
        """SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
  CASE WHEN l_partkey % 53 = 0 THEN 'x'
       WHEN l_partkey % 59 = 0 THEN CAST(l_linenumber AS VARCHAR) || '.7'
       WHEN l_partkey % 61 = 0 THEN 'NA'
       WHEN l_partkey % 67 = 0 THEN CAST(l_linenumber + 3000000000 AS VARCHAR)
       ELSE CAST(l_linenumber AS VARCHAR) END AS order_item_id,
  CAST(l_partkey AS VARCHAR) AS product_id,
  CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN '0.00'
       WHEN l_suppkey % 41 = 0 THEN 'NaN'
       WHEN l_suppkey % 43 = 0 THEN '1,000'
       WHEN l_suppkey % 47 = 0 THEN '-5'
       ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
  CASE WHEN l_partkey % 7 = 0 THEN 'n/a'
       WHEN l_partkey % 11 = 0 THEN '1e1'
       WHEN l_partkey % 13 = 0 THEN '1d'
       WHEN l_partkey % 17 = 0 THEN '2.5f'
       WHEN l_partkey % 19 = 0 THEN '0x1p3'
       ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS freight_value,
  l_partkey AS _p, l_suppkey AS _s, l_shipdate AS _d
FROM lineitem""",
    ),
    (
        "i_n",
        f"""SELECT {na('order_id')} AS order_id, {na('order_item_id')} AS order_item_id,
  {na('product_id')} AS product_id, {na('price')} AS price, {na('freight_value')} AS freight_value,
  _p, _s, _d FROM raw_items""",
    ),
    (
        "i_parsed",
        f"""SELECT order_id, order_item_id AS raw_item_id, {seq('order_item_id')} AS order_item_id, product_id,
  {num('price')} AS price, COALESCE({num('freight_value')}, 0.0) AS freight_value, _p, _s, _d FROM i_n""",
    ),
    (
        "joined",
        """SELECT o.order_id, o.customer_id, o.order_status, o.purchase_ts, o._ord AS _o,
  i.order_item_id, i.product_id, i.price, i.freight_value, i._p, i._s, i._d
FROM o_valid o JOIN i_parsed i ON i.order_id = o.order_id""",
    ),
    ("priced", "SELECT * FROM joined WHERE price > 0.0"),
    (
        "lines0",
        """SELECT order_id, order_item_id AS order_item_seq, customer_id, product_id,
  CAST(strftime(purchase_ts, '%Y%m%d') AS INTEGER) AS date_key, order_status, price, freight_value,
  1 AS quantity, CAST(purchase_ts AS DATE) AS purchase_date, _o, _p, _s, _d FROM priced""",
    ),
    (
        "raw_events",
        """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS order_id,
  CASE event_type WHEN 'purchase' THEN 'F' WHEN 'click' THEN 'O' WHEN 'error' THEN NULL
       ELSE event_type END AS status,
  CASE WHEN event_id % 97 = 0 THEN 'garbage' WHEN event_id % 2 = 0 THEN '2024-06-01 00:00:00'
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_timestamp,
  'seller' || CAST(event_id % 13 AS VARCHAR) AS seller_id,
  CASE WHEN event_type = 'error' THEN 'error event' END AS notes
FROM events""",
    ),
    (
        "headers",
        """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
  o_orderdate AS created_at, o_orderdate + INTERVAL 14 DAY AS expected_delivery,
  CASE o_orderkey % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'app' ELSE 'store' END AS channel
FROM orders""",
    ),
    (
        "ev_n",
        f"""SELECT event_id, {na('order_id')} AS order_id, {na('status')} AS status,
  {na('event_timestamp')} AS event_timestamp, {na('seller_id')} AS seller_id, {na('notes')} AS notes
FROM raw_events""",
    ),
    ("ev_p", f"SELECT CAST(event_id AS BIGINT) AS event_id, order_id, status, {ts('event_timestamp')} AS ets FROM ev_n"),
    (
        "latest",
        """SELECT order_id, status AS latest_event_status FROM ev_p
WHERE order_id IS NOT NULL AND status IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY order_id
  ORDER BY CASE WHEN ets IS NULL THEN 1 ELSE 0 END DESC, ets DESC, event_id DESC, status DESC) = 1""",
    ),
    (
        "lines",
        """SELECT l.order_id, l.order_item_seq, l.customer_id, l.product_id, l.date_key,
  COALESCE(t.latest_event_status, l.order_status) AS order_status, l.price, l.freight_value, l.quantity,
  l.purchase_date, l._o, l._p, l._s, l._d
FROM lines0 l LEFT JOIN latest t ON t.order_id = l.order_id""",
    ),
    (
        "dim_date",
        """SELECT DISTINCT CAST(strftime(purchase_date, '%Y%m%d') AS INTEGER) AS date_key,
  strftime(purchase_date, '%Y-%m-%d') AS full_date, CAST(year(purchase_date) AS INTEGER) AS year,
  CAST(month(purchase_date) AS INTEGER) AS month, CAST(day(purchase_date) AS INTEGER) AS day,
  CAST(quarter(purchase_date) AS INTEGER) AS quarter, dayname(purchase_date) AS weekday
FROM lines WHERE purchase_date IS NOT NULL""",
    ),
    (
        "raw_products",
        """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_partkey % 53 = 0 THEN NULL
       WHEN p_type = 'STANDARD' THEN 'eletronicos'
       WHEN p_type = 'LARGE' THEN '  Fashion_Roupa_Feminina '
       WHEN p_type = 'MEDIUM' THEN 'joias_relogios'
       WHEN p_type = 'ECONOMY' THEN 'FASHION_CALCADOS'
       ELSE lower(p_type) END AS product_category_name,
  p_partkey AS _ord
FROM part""",
    ),
    (
        "p_n",
        f"SELECT {na('product_id')} AS product_id, {na('product_category_name')} AS product_category_name, _ord FROM raw_products",
    ),
    (
        "p_mapped",
        f"""SELECT product_id, category, {category_label('category')} AS name, _ord FROM (
  SELECT product_id, COALESCE(lower({strip('product_category_name')}), 'uncategorized') AS category, _ord
  FROM p_n WHERE product_id IS NOT NULL)""",
    ),
    (
        "api_all",
        """SELECT p_partkey AS id, NOT (p_partkey % 41 = 0) AS valid,
  CASE WHEN p_partkey % 43 = 0 THEN 'electronics'
       WHEN p_partkey % 47 = 0 THEN 'jewelery'
       ELSE CASE p_size % 4 WHEN 0 THEN 'electronics' WHEN 1 THEN 'jewelery'
                            WHEN 2 THEN 'men''s clothing' ELSE 'women''s clothing' END END AS api_category,
  CASE WHEN p_partkey % 43 <> 0 AND p_partkey % 47 = 0 THEN 0.0 ELSE p_retailprice END AS price,
  CASE WHEN p_partkey % 43 = 0 THEN 0.0 ELSE p_size / 10.0 END AS rating
FROM part""",
    ),
    ("api", "SELECT id, api_category, price, rating FROM api_all WHERE valid"),
    (
        "enrich",
        "SELECT api_category, avg(price) AS avg_price, avg(rating) AS avg_rating FROM api GROUP BY api_category",
    ),
    (
        "products_clean",
        """SELECT p.product_id, p.category, p.name, COALESCE(e.avg_price, 0.0) AS api_price,
  COALESCE(e.avg_rating, 0.0) AS api_rating, p._ord
FROM p_mapped p LEFT JOIN enrich e ON e.api_category = p.name
QUALIFY row_number() OVER (PARTITION BY p.product_id ORDER BY p._ord) = 1""",
    ),
    # ------------------------------------------------------------------ single load into an empty star
    (
        "dim_customer",
        """SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id,
  COALESCE(city, '') AS city, COALESCE(state, '') AS state, COALESCE(zip_code, '') AS zip_code
FROM (SELECT * FROM customers_clean
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ord DESC) = 1)""",
    ),
    (
        "dim_product",
        """SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id,
  COALESCE(category, '') AS category, COALESCE(name, '') AS name,
  COALESCE(api_price, 0.0) AS api_price, COALESCE(api_rating, 0.0) AS api_rating
FROM products_clean""",
    ),
    ("dim_status", "SELECT CAST(1 AS BIGINT) AS status_key, 'F' AS status_label UNION ALL SELECT 2, 'O'"),
    (
        "fact_rows",
        """SELECT l.order_id, l.order_item_seq, c.customer_key, p.product_key, l.date_key, s.status_key,
  l.quantity, l.price, l.freight_value, l._o, l._p, l._s, l._d
FROM lines l JOIN dim_customer c ON c.customer_id = l.customer_id
JOIN dim_product p ON p.product_id = l.product_id
LEFT JOIN dim_status s ON s.status_label = l.order_status
WHERE l.date_key IS NOT NULL AND l.date_key IN (SELECT date_key FROM dim_date) AND l.price IS NOT NULL""",
    ),
    (
        "fact_first",
        """SELECT * FROM fact_rows
QUALIFY row_number() OVER (PARTITION BY order_id, order_item_seq ORDER BY _o, _p, _s, _d) = 1""",
    ),
    (
        "fact_orders",
        """SELECT row_number() OVER (ORDER BY order_id, order_item_seq) AS fact_id, order_id, order_item_seq,
  customer_key, product_key, date_key, status_key, quantity, price, freight_value FROM fact_first""",
    ),
    # ------------------------------------------------------------------ quality checks on that star
    (
        "qc_counts",
        """SELECT (SELECT count(*) FROM fact_orders) AS n_fact, (SELECT count(*) FROM dim_customer) AS n_cust,
  (SELECT count(*) FROM dim_product) AS n_prod, (SELECT count(*) FROM dim_date) AS n_date,
  (SELECT count(*) FROM dim_status) AS n_status,
  (SELECT count(*) FROM fact_orders WHERE customer_key IS NULL) AS null_c,
  (SELECT count(*) FROM fact_orders WHERE product_key IS NULL) AS null_p,
  (SELECT count(*) FROM fact_orders WHERE date_key IS NULL) AS null_d,
  (SELECT count(*) FROM fact_orders WHERE price <= 0) AS bad_price,
  (SELECT count(*) FROM fact_orders f WHERE f.customer_key IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_key = f.customer_key)) AS orph_c,
  (SELECT count(*) FROM fact_orders f WHERE f.product_key IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM dim_product d WHERE d.product_key = f.product_key)) AS orph_p,
  (SELECT count(*) FROM fact_orders f WHERE f.date_key IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM dim_date d WHERE d.date_key = f.date_key)) AS orph_d,
  (SELECT count(*) FROM fact_orders f WHERE f.status_key IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM dim_status d WHERE d.status_key = f.status_key)) AS orph_s,
  (SELECT count(*) FROM lines) AS n_staged""",
    ),
]


def pct(num_: str, den: str, decimals: int) -> str:
    scale = 10 ** (decimals + 2)
    unit = 10**decimals
    scaled = f"(CASE WHEN {den} > 0 THEN CAST(floor(({num_} * {scale} * 2 + {den}) / ({den} * 2)) AS BIGINT) ELSE 0 END)"
    return (
        f"(CAST(CAST(floor({scaled} / {unit}) AS BIGINT) AS VARCHAR) || '.' || "
        f"lpad(CAST({scaled} % {unit} AS VARCHAR), {decimals}, '0') || '%')"
    )


def _checks_sql() -> str:
    rows = []
    tables = [("fact_orders", "n_fact"), ("dim_customer", "n_cust"), ("dim_product", "n_prod"), ("dim_date", "n_date"), ("dim_status", "n_status")]
    for i, (t, c) in enumerate(tables):
        rows.append(
            f"SELECT {i + 1} AS seq, 'row_count_{t}' AS \"check\", CASE WHEN {c} > 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
            f"format('{{:,}}', {c}) || ' rows' AS detail, {c} AS value, {c} AS total FROM qc_counts"
        )
    for i, (col, c) in enumerate([("customer_key", "null_c"), ("product_key", "null_p"), ("date_key", "null_d")]):
        ratio = f"(CASE WHEN n_fact > 0 THEN {c} / n_fact ELSE 0.0 END)"
        rows.append(
            f"SELECT {6 + i}, 'null_fk_{col}', CASE WHEN {ratio} <= 0.01 THEN 'PASS' ELSE 'FAIL' END, "
            f"format('{{:,}}', {c}) || ' nulls (' || {pct(c, 'n_fact', 2)} || ')', {c}, n_fact FROM qc_counts"
        )
    rows.append(
        "SELECT 9, 'price_positive', CASE WHEN bad_price = 0 THEN 'PASS' ELSE 'FAIL' END, "
        "format('{:,}', bad_price) || ' rows with price ≤ 0', bad_price, n_fact FROM qc_counts"
    )
    for i, (col, c) in enumerate([("customer_key", "orph_c"), ("product_key", "orph_p"), ("date_key", "orph_d"), ("status_key", "orph_s")]):
        rows.append(
            f"SELECT {10 + i}, 'orphan_fk_{col}', CASE WHEN {c} = 0 THEN 'PASS' ELSE 'FAIL' END, "
            f"format('{{:,}}', {c}) || ' orphan references', {c}, {c} FROM qc_counts"
        )
    rows.append(
        "SELECT 14, 'staging_vs_fact', CASE WHEN n_staged = 0 THEN 'WARN' WHEN n_fact / n_staged >= 0.7 THEN 'PASS' ELSE 'WARN' END, "
        "CASE WHEN n_staged = 0 THEN 'Staging file is empty' ELSE format('{:,}', n_fact) || '/' || format('{:,}', n_staged) "
        f"|| ' staging rows loaded (' || {pct('n_fact', 'n_staged', 1)} || ')' END, n_fact, n_staged FROM qc_counts"
    )
    return "\nUNION ALL\n".join(rows)


CTES.append(("qc", _checks_sql()))


def with_ctes(body: str) -> str:
    """Prefix the query with the whole CTE chain; DuckDB only runs the CTEs the body references."""
    chain = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES)
    return f"WITH {chain}\n{body}"
