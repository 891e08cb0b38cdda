"""Oracle SQL (DuckDB dialect) for every key of ``__spark_entry__.queries()``.

Hand-written, independent of the Spark code: the saved searches are written
out again as plain SQL predicates over the ``products`` fixture view, whose
text is the fixture specification.  Tables are the pre-registered parquet
views.
"""

from __future__ import annotations

# The catalogue fixture (DuckDB text of the same derivation).
PRODUCTS_CTE = """products AS (
SELECT p_partkey AS sku,
  CASE WHEN p_type='STANDARD' AND p_partkey%2=1 THEN concat('MacBook Pro ', p_name)
       WHEN p_type='MEDIUM' AND p_partkey%3=1 THEN concat('Apple AirPods ', p_name) ELSE p_name END AS name,
  CASE WHEN p_partkey%97=0 THEN NULL WHEN p_partkey%89=0 THEN CAST(60696.99 AS DOUBLE)
       ELSE CAST((p_partkey*37%500)*4 AS DOUBLE) + CAST(0.99 AS DOUBLE) END AS "salePrice",
  concat('https://shop.example.com/site/', p_partkey, '/pdp') AS url,
  concat('https://shop.example.com/site/', p_partkey, '/cart') AS "addToCartUrl",
  CASE split_part(p_name,' ',1) WHEN 'red' THEN 'Purple Haze' WHEN 'blue' THEN 'Lilac' WHEN 'hot' THEN 'violet'
       ELSE split_part(p_name,' ',1) END AS color,
  p_partkey%3<>0 AS "onSale", p_partkey%10<>0 AS active, p_partkey%7<>0 AS "onlineAvailability",
  CASE WHEN p_partkey%4<>0 THEN 'Available' ELSE 'SoldOut' END AS orderable,
  CASE WHEN p_partkey%5=0 THEN 'refurbished' ELSE 'new' END AS condition, p_partkey%5=0 AS preowned,
  CAST(p_partkey*7%100 AS DOUBLE) AS "percentSavings", CAST(p_size*2 AS DOUBLE) AS "screenSizeClassIn",
  CASE p_type WHEN 'PROMO' THEN 'Televisions' WHEN 'LARGE' THEN 'Digital_Signage_Displays_and_Players'
       WHEN 'MEDIUM' THEN 'Headphones_and_Headsets' WHEN 'SMALL' THEN 'Gaming_Controllers'
       WHEN 'STANDARD' THEN 'Laptops' ELSE 'Desktops' END AS "productTemplate",
  CASE WHEN p_type='MEDIUM' THEN 'HEADPHONES' ELSE p_type END AS class,
  CASE WHEN p_type='MEDIUM' THEN 410 WHEN p_type='STANDARD' AND p_partkey%2=1 THEN 7835 ELSE p_size END AS "subclassId",
  CASE WHEN p_type='MEDIUM' AND p_partkey%3=1 THEN 'Apple' WHEN p_type='SMALL' THEN 'Sony Interactive' ELSE p_brand END AS manufacturer,
  CASE WHEN p_type='SMALL' AND p_size%2=0 THEN concat('DualSense Wireless Controller ', p_name) END AS "albumTitle",
  CASE p_size%3 WHEN 0 THEN NULL WHEN 1 THEN 'GSR' ELSE '2yr' END AS "protectionPlanTerm",
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(p_partkey%43200) AS "priceUpdateDate",
  CAST(p_partkey // 100 AS INT) + 1 AS page, CAST(p_partkey%100 AS INT) AS pos,
  [{'id':'cat00000','name':'Shop'},{'id':CASE WHEN p_type='MEDIUM' THEN 'abcat0204000' ELSE concat('cat', p_type) END,'name':CASE p_type WHEN 'MEDIUM' THEN 'Headphones' WHEN 'STANDARD' THEN CASE WHEN p_partkey%2=1 THEN 'MacBooks' ELSE 'Laptops' END WHEN 'ECONOMY' THEN 'Desktop Computers' ELSE p_type END}] AS "categoryPath",
  list_concat(list_concat(list_concat([{'name':CASE WHEN p_partkey%3=0 THEN 'BRAND' ELSE 'Brand' END,'value':p_brand}], CASE WHEN p_partkey%4=0 THEN [] ELSE [{'name':'Size','value':CAST(p_size AS VARCHAR)}] END), CASE WHEN p_partkey%6=0 THEN [{'name':'brand','value':'shadowed'}] ELSE [] END), [{'name':'Type','value':CASE WHEN p_partkey%11=0 THEN NULL ELSE p_type END},{'name':'Advanced Graphics Rendering Technique(s)','value':CASE p_size%4 WHEN 1 THEN 'AMD' WHEN 2 THEN 'Iris' ELSE 'NVIDIA' END},{'name':'GPU Model','value':CASE p_size%5 WHEN 0 THEN '1650 Ti' WHEN 1 THEN '1660 Super' ELSE '4070' END},{'name':'Noise Cancelling (Active)','value':CASE WHEN p_size%2=0 THEN 'Noise Canceling' ELSE 'Passive' END},{'name':'Resolution','value':CASE WHEN p_size%3=0 THEN 'Full HD' ELSE '4K' END},{'name':'Processor Model','value':CASE p_size%7 WHEN 0 THEN 'Intel' WHEN 1 THEN 'Intel Core i7' ELSE 'M3' END}]) AS details
FROM part)"""

OFFERS_CTE = """offer_rows AS (
SELECT l_partkey AS sku,
  CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity,
       l_extendedprice) - 1 AS INT) AS offer_pos,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "startDate",
  CAST(CAST(l_shipdate + INTERVAL 7 DAYS AS DATE) AS VARCHAR) AS "endDate"
FROM lineitem)"""

NOW = '(SELECT max("priceUpdateDate") FROM products)'
ORDER = '"salePrice" ASC NULLS LAST, name ASC NULLS LAST, page, pos'
BASE = "lower(orderable) = 'available' AND \"onlineAvailability\" = true AND active = true AND \"onSale\" = true"

# The default projection (also stated in the engine).
DEFAULT_COLUMNS = ["sku", "name", "salePrice", "url", "addToCartUrl"]
DEFAULT_DETAILS = ["Color", "Product Name", "Product Height", "Product Width", "Product Depth",
                   "Product Weight", "Warranty - Labor", "Warranty - Parts"]


def q(ident: str) -> str:
    return '"' + ident.replace('"', '""') + '"'


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def detail(name: str) -> str:
    return f"list_filter(details, lambda d: lower(d.name) = {lit(name.lower())})[1].value"


def any_el(arr: str, field: str, test: str, value: str) -> str:
    if test == "eq":
        cond = f"coalesce(lower(e.{field}) = {lit(value.lower())}, false)"
    else:
        cond = f"coalesce(starts_with(lower(e.{field}), {lit(value.lower())}), false)"
    return f"(len(list_filter({q(arr)}, lambda e: {cond})) > 0)"


def cutoff(minutes: int, zone: str) -> str:
    return f"timezone({lit(zone)}, timezone('UTC', {NOW} - INTERVAL {minutes} MINUTE))"


def projection(columns, details) -> list[str]:
    columns = list(columns or DEFAULT_COLUMNS)
    details = list(details or DEFAULT_DETAILS)
    taken = {c.lower() for c in columns}
    out = [q(c) for c in columns]
    for d in details:
        alias = f"detail.{d}" if d.lower() in taken else d
        out.append(f"{detail(d)} AS {q(alias)}")
    return out


def search_sql(where: str, columns=None, details=None, top: int | None = None) -> str:
    proj = projection(columns, details)
    if top is None:
        return (f"WITH {PRODUCTS_CTE}\nSELECT {', '.join(proj)},\n"
                f"  row_number() OVER (ORDER BY {ORDER}) - 1 AS rank\nFROM products WHERE {where}")
    names = [p.rsplit(" AS ", 1)[-1] if " AS " in p else p for p in proj]
    return (f"WITH {PRODUCTS_CTE},\nhead AS (SELECT {', '.join(proj)}, \"salePrice\" AS __p, name AS __n, page, pos\n"
            f"  FROM products WHERE {where} ORDER BY {ORDER} LIMIT {top})\n"
            f"SELECT {', '.join(names)}, row_number() OVER (ORDER BY __p ASC NULLS LAST, __n ASC NULLS LAST, page, pos) - 1 AS rank FROM head")


HEADPHONE_ATTRS = ["Headphone Fit", "Microphone Features", "Sound Isolating", "Built-In Microphone",
                   "Noise Cancelling (Active)", "Battery Life"]
TV_ATTRS = ["Built-In Speakers", "Resolution", "Display Type", "Screen Size Class", "Screen Size", "Curved Screen"]
LAPTOP_ATTRS = ["Graphics", "Processor Model", "System Memory (RAM)", "Solid State Drive Capacity"]
GPU_ATTRS = ["Advanced Graphics Rendering Technique(s)", "GPU Video Memory (RAM)"] + LAPTOP_ATTRS
FEED_COLS = ["salePrice", "name", "url", "addToCartUrl", "priceUpdateDate"]

W_DISCOUNT = (f'"priceUpdateDate" > {cutoff(1441, "US/Pacific")} AND "onSale" AND active '
              f'AND "percentSavings" > 50 AND "salePrice" IS DISTINCT FROM 60696.99')
W_HEADPHONES = (f"lower(\"productTemplate\") = 'headphones_and_headsets' AND lower(class) = 'headphones' "
                f"AND \"subclassId\" = 410 AND {any_el('details', 'value', 'prefix', 'noise cancel')} AND {BASE}")
W_AIRPODS = (f"list_contains(regexp_split_to_array(lower(name), '\\W+'), 'airpods') AND lower(manufacturer) = 'apple' "
             f"AND {any_el('categoryPath', 'id', 'eq', 'abcat0204000')} AND {BASE} "
             f"AND NOT coalesce(lower(\"protectionPlanTerm\") = 'gsr', false)")
W_CONTROLLER = (f"lower(\"productTemplate\") = 'gaming_controllers' AND starts_with(lower(manufacturer), 'sony') "
                f"AND starts_with(lower(\"albumTitle\"), 'dualsense wireless controller') AND {BASE}")
W_TV = (f"lower(\"productTemplate\") IN ('televisions', 'digital_signage_displays_and_players', 'portable_tvs_and_video') "
        f"AND \"screenSizeClassIn\" > 84 AND \"salePrice\" < 1000 AND NOT {any_el('details', 'value', 'eq', 'Full HD')} AND {BASE}")
W_MACBOOK = (f"starts_with(lower(name), 'macbook pro') AND {any_el('categoryPath', 'name', 'prefix', 'macbook')} "
             f"AND NOT {any_el('details', 'value', 'eq', 'intel')} AND {BASE} AND preowned = false AND \"subclassId\" = 7835")


def w_gpu(category: str) -> str:
    return (f"{any_el('categoryPath', 'name', 'prefix', category)} AND {BASE} "
            f"AND {any_el('details', 'value', 'eq', 'nvidia')} AND NOT {any_el('details', 'value', 'prefix', '1650')} "
            f"AND NOT {any_el('details', 'value', 'prefix', '1660')}")


W_PURPLE = ("\"onSale\" AND lower(condition) = 'new' AND active AND ("
            + " OR ".join(f"starts_with(lower(color), '{c}')" for c in
                          ["purple", "lilac", "lavender", "violet", "amethyst", "plum"]) + ")")
W_AIRPODS_RECENT = f'{W_AIRPODS} AND "priceUpdateDate" > {cutoff(16, "US/Central")}'
W_MACBOOK_CHEAP = (f"{any_el('categoryPath', 'name', 'prefix', 'macbook')} AND \"salePrice\" < 1000 "
                   f"AND NOT {any_el('details', 'value', 'prefix', 'intel')} AND {BASE}")
W_GPU_CHEAP = f"{w_gpu('laptop')} AND \"salePrice\" < 1000"
W_TV_TOP = "lower(\"productTemplate\") IN ('televisions') AND \"screenSizeClassIn\" > 39 AND \"salePrice\" < 999"
W_GPU_TOP = (f"{any_el('categoryPath', 'name', 'prefix', 'laptop')} AND \"onSale\" = true "
             f"AND {any_el('details', 'value', 'eq', 'nvidia')}")

SEARCHES = {
    "q_discount": search_sql(W_DISCOUNT, FEED_COLS, []),
    "q_headphones": search_sql(W_HEADPHONES, None, HEADPHONE_ATTRS),
    "q_airpods": search_sql(W_AIRPODS, None, HEADPHONE_ATTRS),
    "q_controller": search_sql(W_CONTROLLER, ["salePrice", "name", "color", "url", "addToCartUrl"], []),
    "q_television": search_sql(W_TV, None, TV_ATTRS),
    "q_macbook_pro": search_sql(W_MACBOOK, ["sku", "name", "salePrice", "onSale", "url", "addToCartUrl"], LAPTOP_ATTRS),
    "q_gpu_laptop": search_sql(w_gpu("laptop"), None, GPU_ATTRS),
    "q_gpu_desktop": search_sql(w_gpu("desktop"), None, GPU_ATTRS),
    "q_purple": search_sql(W_PURPLE, FEED_COLS, []),
    "q_airpods_recent": search_sql(W_AIRPODS_RECENT, None, HEADPHONE_ATTRS),
    "q_macbook_cheap": search_sql(W_MACBOOK_CHEAP, None, LAPTOP_ATTRS),
    "q_gpu_laptop_cheap": search_sql(W_GPU_CHEAP, None, GPU_ATTRS),
    "q_tv_top10": search_sql(W_TV_TOP, None, None, top=10),
    "q_gpu_top10": search_sql(W_GPU_TOP, None, None, top=10),
}



def select(where: str, cols: str) -> str:
    return f"WITH {PRODUCTS_CTE}\nSELECT {cols} FROM products WHERE {where}"


EVENTS = "(SELECT event_id, user_id AS sku, ts AS \"priceUpdateDate\", value AS \"salePrice\" FROM events WHERE event_type = 'purchase')"
ALL_EVENTS = "(SELECT event_id, ts AS \"priceUpdateDate\" FROM events)"
RANK = f"row_number() OVER (ORDER BY {ORDER}) - 1 AS rank"
PROBE_ATTRS = ["brand", "SIZE", "Type", "Color"]
PIVOT_ATTRS = list(dict.fromkeys(GPU_ATTRS + TV_ATTRS + HEADPHONE_ATTRS))

# name, where, columns, details  (the HTTP pack, in pack order)
HTTP_PACK = [
    ("discount", W_DISCOUNT, FEED_COLS, None),
    ("headphones", W_HEADPHONES, None, HEADPHONE_ATTRS),
    ("airpods", W_AIRPODS, None, HEADPHONE_ATTRS),
    ("ps5 controller", W_CONTROLLER, ["salePrice", "name", "color", "url", "addToCartUrl"], None),
    ("television", W_TV, None, TV_ATTRS),
    ("macbook", W_MACBOOK, ["sku", "name", "salePrice", "onSale", "url", "addToCartUrl"], LAPTOP_ATTRS),
    ("nvidia", w_gpu("laptop"), None, GPU_ATTRS),
    ("desktop", w_gpu("desktop"), None, GPU_ATTRS),
    ("purple", W_PURPLE, FEED_COLS, None),
]
TYPES = {"sku": "bigint", "salePrice": "double", "onSale": "boolean", "priceUpdateDate": "timestamp"}


def esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def links(x: str) -> str:
    return (f"replace(replace(replace({x}, 'http', '<a href=\"http'), '/pdp', '/pdp\" target=\"_blank\">urlLink</a>'), "
            f"'/cart', '/cart\" target=\"_blank\">addToCartUrl</a>')")


def cell(expr: str, dtype: str, name: str) -> str:
    if dtype == "boolean":
        txt = f"CASE WHEN {expr} THEN 'True' WHEN NOT {expr} THEN 'False' END"
    elif dtype == "timestamp":
        txt = f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
    elif dtype == "double":
        txt = f"regexp_replace(CAST(CAST({expr} AS DECIMAL(38,6)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1')"
    else:
        txt = f"CAST({expr} AS VARCHAR)"
    out = esc(f"coalesce({txt}, '{'NaN' if dtype == 'double' else 'None'}')")
    if name in ("url", "addToCartUrl"):
        out = links(out)
    return f"'<td>' || {out} || '</td>'"


def cells(columns, details) -> str:
    columns = list(columns or DEFAULT_COLUMNS)
    details = list(details or DEFAULT_DETAILS)
    parts = [cell(q(c), TYPES.get(c, "string"), c) for c in columns]
    parts += [cell(detail(d), "string", d) for d in details]
    return " || ".join(parts)


NONE = "'None'"


def heading(columns, details) -> str:
    columns = list(columns or DEFAULT_COLUMNS)
    taken = {c.lower() for c in columns}
    names = columns + [f"detail.{d}" if d.lower() in taken else d for d in (details or DEFAULT_DETAILS)]
    names += ["offer.startDate", "offer.endDate"]
    return lit("<tr><th></th>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>")


def row_line(index: str, columns, details) -> str:
    """A line of a result row joined with its offers (alias ``o``)."""
    n = width(columns, details) - 2
    offer = " || ".join(
        f"'<td>' || CASE WHEN o.offer_pos IS NULL THEN '{{}}' ELSE o.offer_pos || ': ' || {esc(f'coalesce(o.{q(f)}, {NONE})')} END || '</td>'"
        for f in ("startDate", "endDate"))
    return (f"CASE WHEN coalesce(o.offer_pos, 0) = 0 THEN '<tr><th>' || {index} || '</th>' || {cells(columns, details)} "
            f"ELSE {lit('<tr><th></th>' + '<td></td>' * n)} END || {offer} || '</tr>'")


def width(columns, details) -> int:
    return len(columns or DEFAULT_COLUMNS) + len(details or DEFAULT_DETAILS) + 2


def tagged_union(pack) -> str:
    return " UNION ALL ".join(f"SELECT {lit(n)} AS query_name, * FROM products WHERE {w}" for n, w, _, _ in pack)


def shapes_cte(pack) -> str:
    listing = ", ".join(f"({lit(n)}, {i}, {width(c, d)})" for i, (n, _, c, d) in enumerate(pack))
    return (f"tagged AS ({tagged_union(pack)}),\n"
            f"listing(query_name, pack_order, width) AS (VALUES {listing}),\n"
            f"counts AS (SELECT query_name, count(*) AS n FROM tagged GROUP BY query_name),\n"
            f"shapes AS (SELECT l.query_name, l.pack_order, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows,\n"
            f"  CAST(CASE WHEN coalesce(c.n, 0) > 0 THEN l.width ELSE 0 END AS INT) AS n_cols\n"
            f"  FROM listing l LEFT JOIN counts c USING (query_name))")


def pack_wide_sql(pack) -> str:
    taken = {c.lower() for _, _, cols, _ in pack for c in (cols or DEFAULT_COLUMNS)}
    blocks = []
    for n, w, cols, dets in pack:
        cols = list(cols or DEFAULT_COLUMNS)
        dets = list(dets or DEFAULT_DETAILS)
        proj = [q(c) for c in cols]
        proj += [f"{detail(d)} AS {q('detail.' + d if d.lower() in taken else d)}" for d in dets]
        blocks.append(f"SELECT {lit(n)} AS query_name, {', '.join(proj)}, {RANK} FROM products WHERE {w}")
    return f"WITH {PRODUCTS_CTE}\n" + "\nUNION ALL BY NAME\n".join(blocks)


def document_sql(pack) -> str:
    body, heads = [], []
    for i, (n, w, cols, dets) in enumerate(pack):
        heads.append(f"SELECT {i} AS pack_order, {heading(cols, dets)} AS text")
        body.append(f"SELECT {i} AS pack_order, r.idx, coalesce(o.offer_pos, 0) AS opos, {row_line('r.landing', cols, dets)} AS text "
                    f"FROM (SELECT *, row_number() OVER (ORDER BY {ORDER}) - 1 AS idx, row_number() OVER (ORDER BY page, pos) - 1 AS landing "
                    f"FROM products WHERE {w}) r LEFT JOIN offer_rows o USING (sku)")
    return (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE},\n{shapes_cte(pack)},\nbody AS ({' UNION ALL '.join(body)}),\n"
            f"lines AS (SELECT pack_order, 0 AS part, 0 AS idx, 0 AS opos, query_name || ' (' || n_rows || ', ' || n_cols || '):</br>' AS text FROM shapes\n"
            f"  UNION ALL SELECT pack_order, 1, 0, 0, text FROM ({' UNION ALL '.join(heads)})\n"
            f"  UNION ALL SELECT pack_order, 2, idx, opos, text FROM body\n"
            f"  UNION ALL SELECT pack_order, 3, 0, 0, '</br>' FROM shapes)\n"
            f"SELECT row_number() OVER (ORDER BY pack_order, part, idx, opos) - 1 AS doc_line, text FROM lines")


DISCOUNT_RANKED = f"SELECT *, {RANK} FROM products WHERE {W_DISCOUNT}"
MORE = {
    "prd_eq_str": select("lower(manufacturer) = 'apple'", "sku, manufacturer"),
    "prd_eq_bool": select("preowned = false", "sku, preowned"),
    "prd_eq_int": select('"subclassId" = 410', 'sku, "subclassId"'),
    "prd_ne_str": select("NOT coalesce(lower(\"protectionPlanTerm\") = 'gsr', false)", 'sku, "protectionPlanTerm"'),
    "prd_ne_num": select('"salePrice" IS DISTINCT FROM 60696.99', 'sku, "salePrice"'),
    "prd_lt": select('"salePrice" < 1000', 'sku, "salePrice"'),
    "prd_gt": select('"screenSizeClassIn" > 84', 'sku, "screenSizeClassIn"'),
    "prd_gt_ts": select(f'"priceUpdateDate" > {cutoff(1441, "US/Pacific")}', 'sku, "priceUpdateDate"'),
    "prd_prefix": select("starts_with(lower(manufacturer), 'sony')", "sku, manufacturer"),
    "prd_in": select("lower(\"productTemplate\") IN ('televisions', 'digital_signage_displays_and_players', "
                     "'portable_tvs_and_video')", 'sku, "productTemplate"'),
    "prd_and": select(BASE, "sku, orderable"),
    "prd_or_group": select("(" + " OR ".join(f"starts_with(lower(color), '{c}')" for c in
                                             ["purple", "lilac", "lavender", "violet", "amethyst", "plum"]) + ")",
                           "sku, color"),
    "prd_any_eq": select(any_el("details", "value", "eq", "nvidia"), "sku, name"),
    "prd_any_prefix": select(any_el("categoryPath", "name", "prefix", "laptop"), "sku, name"),
    "prd_none_eq": select("NOT " + any_el("details", "value", "eq", "intel"), "sku, name"),
    "prd_none_prefix": select("NOT " + any_el("details", "value", "prefix", "1650"), "sku, name"),
    "prd_search": select("list_contains(regexp_split_to_array(lower(name), '\\W+'), 'airpods')", "sku, name"),
    "prd_anti_prefix_local": (f"WITH {PRODUCTS_CTE},\nflat AS (SELECT *, {detail('Processor Model')} AS \"Processor Model\" FROM products)\n"
                              f"SELECT sku, name, \"salePrice\", \"Processor Model\", {RANK} FROM flat "
                              f"WHERE NOT coalesce(starts_with(\"Processor Model\", 'Intel'), false)"),
    "prj_columns": select("true", 'sku, name, "salePrice", "onSale", url, "addToCartUrl"'),
    "prj_defaults": select("true", ", ".join(projection(None, None))),
    "prj_detail_first": select("true", "sku, " + ", ".join(f"{detail(a)} AS {q(a)}" for a in PROBE_ATTRS)),
    "prj_detail_pivot": select("true", "sku, " + ", ".join(f"{detail(a)} AS {q(a)}" for a in PIVOT_ATTRS)),
    "prj_offer_map": (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE}\nSELECT sku, offer_pos, \"startDate\" AS \"offer.startDate\", "
                      f"\"endDate\" AS \"offer.endDate\" FROM offer_rows WHERE sku IN (SELECT sku FROM products)"),
    "prj_row_index": select(W_DISCOUNT, "sku, row_number() OVER (ORDER BY page, pos) - 1 AS row_index"),
    "prj_rank_index": select(W_DISCOUNT, f"sku, {RANK}"),
    "prj_query_tag": select(W_DISCOUNT, f"'discount' AS query_name, name, \"salePrice\", {RANK}, "
                            f"count(*) OVER () AS n_rows, CASE WHEN count(*) OVER () > 0 THEN 15 ELSE 0 END AS n_cols"),
    "sort_price_name": select("true", f'sku, "salePrice", name, {RANK}'),
    "page_slice": f"WITH {PRODUCTS_CTE}, r AS (SELECT sku, \"salePrice\", name, {RANK} FROM products)\nSELECT * FROM r WHERE rank >= 10 AND rank < 20",
    "page_deep": f"WITH {PRODUCTS_CTE}, r AS (SELECT sku, \"salePrice\", name, {RANK} FROM products)\nSELECT * FROM r WHERE rank >= 1400 AND rank < 1500",
    "topk_cheapest": f"WITH {PRODUCTS_CTE}, r AS (SELECT sku, \"salePrice\", name, {RANK} FROM products)\nSELECT * FROM r WHERE rank < 10",
    "set_union_pages": select("true", 'page, pos, sku, name, "salePrice", url'),
    "set_pack_tagged": f"WITH {PRODUCTS_CTE}, tagged AS ({tagged_union(HTTP_PACK)})\nSELECT query_name, sku FROM tagged",
    "set_pack_index": f"""WITH {PRODUCTS_CTE},
searches AS (SELECT 'Brand#' || b AS brand, t AS template, m AS price_limit
  FROM range(10, 60) x(b), unnest(['Televisions', 'Digital_Signage_Displays_and_Players', 'Headphones_and_Headsets',
       'Gaming_Controllers', 'Laptops', 'Desktops']) y(t), unnest([200, 400, 700, 1000, 1300, 1600, 1900]) z(m))
SELECT concat(brand, ' ', template, ' under ', price_limit) AS query_name, sku
FROM products JOIN searches ON manufacturer = brand AND "productTemplate" = template AND "salePrice" < price_limit
WHERE active AND len(list_filter(details, lambda d: coalesce(starts_with(lower(d.value), 'intel'), false))) = 0""",
    "set_pack_wide": pack_wide_sql(HTTP_PACK),
    "agg_shape": f"WITH {PRODUCTS_CTE},\n{shapes_cte(HTTP_PACK)}\nSELECT query_name, n_rows, n_cols FROM shapes",
    "agg_sum_totals": (f"WITH {PRODUCTS_CTE}\nSELECT (SELECT count(*) FROM products WHERE {W_TV_TOP}) + "
                       f"(SELECT count(*) FROM products WHERE {W_GPU_TOP}) AS total_products"),
    "agg_document": document_sql(HTTP_PACK),
    "scl_link_rewrite": select("true", f"sku, {links('url')} AS url_html, {links(q('addToCartUrl'))} AS cart_html"),
    "scl_lookback": (f"SELECT event_id, \"priceUpdateDate\" - INTERVAL 1441 MINUTE AS daily_since, "
                     f"\"priceUpdateDate\" - INTERVAL 16 MINUTE AS frequent_since FROM {ALL_EVENTS}"),
    "scl_tz_cutoff": (f"SELECT event_id, timezone('US/Pacific', timezone('UTC', \"priceUpdateDate\" - INTERVAL 1441 MINUTE)) AS daily_cutoff, "
                      f"timezone('US/Central', timezone('UTC', \"priceUpdateDate\" - INTERVAL 16 MINUTE)) AS frequent_cutoff FROM {ALL_EVENTS}"),
    "scl_cutoff_text": (f"SELECT event_id, strftime(timezone('US/Pacific', timezone('UTC', \"priceUpdateDate\" - INTERVAL 1441 MINUTE)), '%Y-%m-%dT%H:%M:%S') AS daily_text, "
                        f"strftime(timezone('US/Central', timezone('UTC', \"priceUpdateDate\" - INTERVAL 16 MINUTE)), '%Y-%m-%dT%H:%M:%S') AS frequent_text FROM {ALL_EVENTS}"),
    "scl_first_word": select("true", "sku, split_part(name, ' ', 1) AS first_word"),
    "scl_after_token": select("true", "sku, split_part(url, 'site', 2) AS path"),
    "scl_ceil_div": (f"WITH {PRODUCTS_CTE},\n{shapes_cte(HTTP_PACK)}\nSELECT query_name, n_rows AS total, "
                     f"CAST((n_rows + 99) // 100 AS BIGINT) AS pages_100, CAST((n_rows + 9) // 10 AS BIGINT) AS pages_10 FROM shapes"),
    "rpt_table": (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE}, r AS ({DISCOUNT_RANKED})\n"
                  f"SELECT -1 AS rank, -1 AS offer_pos, {heading(FEED_COLS, None)} AS row_html\n"
                  f"UNION ALL SELECT rank, coalesce(o.offer_pos, 0), {row_line('rank', FEED_COLS, None)} FROM r LEFT JOIN offer_rows o USING (sku)"),
    "rpt_digest": (f"WITH {PRODUCTS_CTE},\n{shapes_cte(HTTP_PACK)}\nSELECT query_name, '<p>New deals since: ' || "
                   f"strftime({cutoff(1441, 'US/Pacific')}, '%Y-%m-%dT%H:%M:%S') || '</p><br/>' || chr(10) || "
                   f"'<p>total shape: (' || n_rows || ', ' || n_cols || ')</p></br>' AS header FROM shapes"),
}



ALL_SEARCHES = HTTP_PACK + [
    ("airpods recent", W_AIRPODS_RECENT, None, HEADPHONE_ATTRS),
    ("macbook cheap", W_MACBOOK_CHEAP, None, LAPTOP_ATTRS),
    ("nvidia cheap", W_GPU_CHEAP, None, GPU_ATTRS),
    ("television top10", W_TV_TOP, None, None),
    ("nvidia top10", W_GPU_TOP, None, None),
]
# first word of each saved search's subject (the export folder name)
EXPORT_NAMES = {"discount": "Discount>50%", "headphones": "Headphones", "airpods": "Airpods",
                "ps5 controller": "Controller", "television": "Television", "macbook": "Macbook",
                "nvidia": "Laptops", "desktop": "Desktops", "purple": "Purple"}
OFFER_JSON = ("om AS (SELECT sku, '{' || string_agg('\"' || offer_pos || '\":\"' || \"startDate\" || '\"', ',' ORDER BY offer_pos) || '}' AS s,\n"
              "  '{' || string_agg('\"' || offer_pos || '\":\"' || \"endDate\" || '\"', ',' ORDER BY offer_pos) || '}' AS e FROM offer_rows GROUP BY sku)")

INGEST = {
    "src_pages": (f"WITH {PRODUCTS_CTE}\nSELECT CAST(page AS INT) AS \"currentPage\", CAST((t.total + 99) // 100 AS INT) AS \"totalPages\", "
                  f"t.total AS total, CAST(count(*) AS INT) AS n_products FROM products, (SELECT count(*) AS total FROM products) t GROUP BY page, t.total"),
    "src_valid_pages": f"WITH {PRODUCTS_CTE}\nSELECT CAST(page AS INT) AS \"currentPage\", CAST(count(*) AS INT) AS n_products FROM products GROUP BY page",
    "src_flatten": (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE}\nSELECT p.page, p.pos, p.sku, p.name, p.\"salePrice\", "
                    f"CASE WHEN p.sku % 997 = 0 THEN NULL ELSE p.\"addToCartUrl\" END AS \"addToCartUrl\", "
                    f"CAST(coalesce(o.n, 0) AS INT) AS n_offers FROM products p LEFT JOIN (SELECT sku, count(*) AS n FROM offer_rows GROUP BY sku) o USING (sku)"),
    "prj_page_reject": (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE}, {OFFER_JSON}\nSELECT page, pos, {', '.join(projection(None, None))}, "
                        f"coalesce(om.s, '{{}}') AS \"offer.startDate\", coalesce(om.e, '{{}}') AS \"offer.endDate\" "
                        f"FROM products LEFT JOIN om USING (sku) WHERE page NOT IN (SELECT page FROM products WHERE sku % 997 = 0)"),
    "agg_reported_total": f"WITH {PRODUCTS_CTE}\nSELECT count(*) AS total, CAST((count(*) + 99) // 100 AS INT) AS \"totalPages\" FROM products",
    "page_plan": (f"WITH {PRODUCTS_CTE},\n{shapes_cte(HTTP_PACK)}\nSELECT query_name, CAST(page AS INT) AS page, CAST((page - 1) // 4 AS INT) AS batch "
                  f"FROM (SELECT query_name, unnest(range(1, CAST((n_rows + 99) // 100 AS BIGINT) + 1)) AS page FROM shapes)"),
    "page_audit": (f"WITH {PRODUCTS_CTE}\nSELECT DISTINCT page, 'rejected' AS status FROM products WHERE sku % 997 = 0 AND page % 7 <> 4 "
                   f"UNION ALL SELECT CAST(p AS INT), 'lost' FROM (SELECT unnest(range(1, CAST((count(*) + 99) // 100 AS BIGINT) + 1)) AS p FROM products) "
                   f"WHERE p % 7 = 4 OR p NOT IN (SELECT page FROM products)"),
    "page_intervals": (f"WITH {PRODUCTS_CTE}, pages AS (SELECT CAST(p AS BIGINT) AS page, p % 7 = 4 OR p NOT IN (SELECT page FROM products) AS lost, "
                       f"EXISTS (SELECT 1 FROM products x WHERE x.page = p AND x.sku % 997 = 0) AS bad "
                       f"FROM (SELECT unnest(range(1, CAST((count(*) + 99) // 100 AS BIGINT) + 1)) AS p FROM products)), "
                       f"marked AS (SELECT page, CASE WHEN lost THEN 'lost' ELSE 'rejected' END AS status FROM pages WHERE lost OR bad), "
                       f"runs AS (SELECT *, page - row_number() OVER (PARTITION BY status ORDER BY page) AS island FROM marked)\n"
                       f"SELECT status, min(page) AS first_page, max(page) AS last_page, count(*) AS n_pages FROM runs GROUP BY status, island"),
    "prj_open_schema": (f"WITH {PRODUCTS_CTE}, lines AS (SELECT l_partkey AS sku, l_orderkey || '-' || l_linenumber AS id, "
                        f"row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) - 1 AS p FROM lineitem),\n"
                        f"om AS (SELECT sku, '{{' || string_agg('\"' || p || '\":\"' || id || '\"', ',' ORDER BY p) || '}}' AS m FROM lines GROUP BY sku)\n"
                        f"SELECT page, pos, 'MX-' || sku AS \"modelNumber\", sku, '{{\"row\":' || sku % 9 || '}}' AS shelf, name, {detail('Brand')} AS \"Brand\", "
                        f"coalesce(m, '{{}}') AS \"offer.id\" FROM products LEFT JOIN om USING (sku)"),
    "set_pack_offers": (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE}, hits AS (" + " UNION ALL ".join(
        f"SELECT * FROM (SELECT {lit(n)} AS query_name, sku, {RANK} FROM products WHERE {w})" + (" WHERE rank < 10" if n.endswith("top10") else "")
        for n, w, _, _ in ALL_SEARCHES) + ")\nSELECT query_name, rank, offer_pos, \"startDate\" AS \"offer.startDate\", "
        "\"endDate\" AS \"offer.endDate\" FROM hits JOIN offer_rows USING (sku)"),
    "empty_result": search_sql(f'{W_DISCOUNT} AND "priceUpdateDate" > {NOW}', FEED_COLS, []),
    "export_roundtrip": (f"WITH {PRODUCTS_CTE}, {OFFERS_CTE}, r AS (" + "\nUNION ALL\n".join(
        f"SELECT {lit(EXPORT_NAMES[n])} AS export_name, {lit(n)} AS query_name, sku, name, \"salePrice\", {RANK} FROM products WHERE {w}"
        for n, w, _, _ in HTTP_PACK) + ")\nSELECT export_name, query_name, name, \"salePrice\", rank, offer_pos, "
        "\"startDate\" AS \"offer.startDate\", \"endDate\" AS \"offer.endDate\" FROM r LEFT JOIN offer_rows USING (sku)"),
    "report_nonempty": f"WITH {PRODUCTS_CTE},\n{shapes_cte(ALL_SEARCHES)}\nSELECT query_name, n_rows FROM shapes WHERE n_rows > 0",
    "obs_counts": select(W_DISCOUNT, "count(*) AS n_products"),
}


DISTINCT_UPDATES = f"(SELECT DISTINCT event_id, sku, \"priceUpdateDate\", \"salePrice\" FROM {EVENTS})"
# Two runs: up to the middle of the time span, and after it; each sku's newest change of a run.
RUNS = (f"(SELECT *, \"priceUpdateDate\" > (SELECT min(\"priceUpdateDate\") + (max(\"priceUpdateDate\") - min(\"priceUpdateDate\")) / 2 "
        f"FROM {EVENTS}) AS run FROM {DISTINCT_UPDATES})")
NEWEST = (f"(SELECT sku, \"salePrice\", \"priceUpdateDate\" FROM {RUNS} QUALIFY row_number() OVER "
          f"(PARTITION BY run, sku ORDER BY \"priceUpdateDate\" DESC, \"salePrice\" DESC) = 1)")
UPDATED = (f"updated AS (SELECT p.* REPLACE (e.\"salePrice\" AS \"salePrice\", e.\"priceUpdateDate\" AS \"priceUpdateDate\") "
           f"FROM products p JOIN {NEWEST} e USING (sku))")
STREAMS = {
    "stream_pages": INGEST["src_valid_pages"],
    "stream_recent": (f"SELECT * FROM {EVENTS} WHERE \"priceUpdateDate\" > timezone('US/Central', timezone('UTC', "
                      f"(SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 16 MINUTE))"),
    "stream_dedupe": f"SELECT * FROM {DISTINCT_UPDATES}",
    "stream_out_of_order": f"SELECT * FROM {DISTINCT_UPDATES}",
    "stream_report": (f"WITH {PRODUCTS_CTE}, {UPDATED}\nSELECT query_name, count(*) AS n_rows FROM ("
                      + " UNION ALL ".join(f"SELECT {lit(n)} AS query_name FROM updated WHERE {w}" for n, w, _, _ in HTTP_PACK)
                      + ") GROUP BY query_name"),
}


# The newest change of each product, applied to the catalogue; "now" stays the catalogue's own.
CHANGED = """changed AS (SELECT p.* REPLACE (coalesce(u.price, p."salePrice") AS "salePrice", coalesce(u.at, p."priceUpdateDate") AS "priceUpdateDate")
FROM products p LEFT JOIN (SELECT user_id AS sku, max(ts) AS at, max({'at': ts, 'price': value}).price AS price
  FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL AND value IS NOT NULL GROUP BY user_id) u USING (sku))"""
STREAMS["stream_live"] = (f"WITH {PRODUCTS_CTE}, {CHANGED},\n{shapes_cte(HTTP_PACK).replace('FROM products WHERE', 'FROM changed WHERE')}\n"
                          "SELECT query_name, n_rows FROM shapes")


# The two overlapping runs: up to the middle of the time span, and from a day and a minute before it.
OBSERVED = f"""WITH u AS (SELECT * FROM {EVENTS}),
m AS (SELECT min("priceUpdateDate") + (max("priceUpdateDate") - min("priceUpdateDate")) / 2 AS mid FROM u)
SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n_rows, min("priceUpdateDate") AS first_ts, max("priceUpdateDate") AS last_ts
FROM u, m WHERE "priceUpdateDate" <= mid
UNION ALL SELECT 1, count(*), min("priceUpdateDate"), max("priceUpdateDate") FROM u, m WHERE "priceUpdateDate" >= mid - INTERVAL 1441 MINUTE"""


def all_sql() -> dict[str, str]:
    out = dict(SEARCHES)
    out.update(MORE)
    # The same conditions, over a stored inverted table.
    out.update({f"idx_{k}": MORE[f"prd_{k}"] for k in ("any_eq", "any_prefix", "none_eq", "none_prefix", "search")})
    out.update(INGEST)
    out.update(STREAMS)
    out["obs_batches"] = OBSERVED
    out["export_committed"] = out["export_roundtrip"]
    return out
