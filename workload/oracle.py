"""The registered queries in plain SQL over the given tables, written independently.

Money is integer cents, quantities are integers scaled by 10^12 or 10^6 inside the SQL and
doubles at the end, so both sides are exact.
"""

from __future__ import annotations

import re

from millwright.operators import tag_rules
from millwright.sources.regions import REGIONS
from workload.adapters import PARAMS, TYPE_TAGS, WORD_TAGS

M12 = "1000000000000"


def _case(column: str, words: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items())
    return f"CASE {column} {whens} ELSE {column} END"


def initcap(x: str) -> str:
    runs = f"regexp_extract_all(lower({x}), '([a-z0-9]+|[^a-z0-9]+)')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), '')"


def half_up(n: str, d: str) -> str:
    return f"((2*({n}) + ({d})) // (2*({d})))"


def half_up_signed(n: str, d: str) -> str:
    return f"(sign({n})::HUGEINT * ((2*abs({n}) + ({d})) // (2*({d}))))"


def as_double(micro: str) -> str:
    return f"(({micro})::HUGEINT / 1e6)"


def fold(units12: str) -> str:
    """Evaluate a path: fs holds factors x 10^12, negative where the step is not rounded."""
    product = f"((a // {M12}) * abs(f) + ((a % {M12}) * abs(f) + 500000000000) // {M12})"
    rounded = (f"CASE WHEN f < 0 THEN {product} WHEN kind = 'FLOOR' THEN ({product} // {M12}) * {M12} "
               f"ELSE (({product} + {M12} - 1) // {M12}) * {M12} END")
    return f"list_reduce(list_prepend(({units12})::HUGEINT, fs), lambda a, f: {rounded})"


def six(x12: str) -> str:
    return f"((({x12}) + 500000) // 1000000)"


def q_copy(u: str, r: int) -> str:
    """Six-decimal integer quantity from copies of r runs."""
    return (f"({six(fold(f'{r}::HUGEINT*{M12}'))} * (({u}) // {r}) + {six(fold(f'(({u}) % {r})::HUGEINT*{M12}'))})")


def tagged(keyword: str) -> str:
    return f"(SELECT part_id FROM tags WHERE keyword = '{keyword}')"


CTES: dict[str, str] = {}

CTES["parts"] = f"""SELECT p_partkey AS part_id, upper(p_name) || ' ' || p_partkey AS label,
  CASE WHEN p_partkey % 10 <> 0 THEN p_partkey*3+7 END AS external_id, p_size::BIGINT * 100 AS vol_milli,
  p_partkey % 11 AS me, CASE WHEN p_partkey % 40 = 0 THEN 40 ELSE 1 END::BIGINT AS units,
  CASE WHEN p_partkey % 10 <> 0 THEN p_partkey*7 % 500 END AS pile, p_type, p_brand, p_size, p_name,
  '/' || {_case('p_type', TYPE_TAGS)} || '//' || p_brand || '/' ||
  {_case("upper(regexp_extract(p_name, '[^ ]*$'))", WORD_TAGS)} || '/' AS path
  FROM part"""
CTES["tags"] = """SELECT DISTINCT part_id, keyword FROM (
  SELECT part_id, unnest(string_split(upper(trim(path, '/')), '/')) AS keyword FROM parts) WHERE keyword <> ''"""
CTES["edges"] = """SELECT g.part_id*10 + j AS edge_id, g.part_id AS good_id, p.part_id, g.label AS good, p.label AS part,
  ((g.part_id*31 + j*17) % 5 + 1)*100 + CASE WHEN j = 2 THEN 17 ELSE 0 END AS qty100
  FROM parts g, (VALUES (1),(2),(3),(4),(9)) s(j), parts p
  WHERE (j < 9 OR g.part_id % 7 = 0) AND p.part_id = g.part_id*4 + j"""
CTES["rates"] = """SELECT *, CASE WHEN print THEN 'NONE' WHEN raw THEN 'FLOOR' ELSE 'CEIL' END AS round_kind,
  ((2*qty100*pos4*1000000 + units) // (2*units))::HUGEINT AS factor12
  FROM (SELECT *, CASE WHEN raw THEN base4 WHEN qty100 = 100 OR print OR research THEN 10000 ELSE base4 END AS station4,
    CASE WHEN raw THEN base4 WHEN qty100 = 100 OR print OR research THEN 10000 WHEN no_pos THEN base4 ELSE (100-me)*98 END AS pos4
    FROM (SELECT e.*, g.me, g.units, (100-g.me)*100 AS base4,
      e.good_id IN (SELECT part_id FROM tags WHERE keyword = 'RAW MATERIALS') AS raw,
      e.good_id IN (SELECT part_id FROM tags WHERE keyword = 'BLUEPRINTS')
        OR e.part_id IN (SELECT part_id FROM tags WHERE keyword = 'BLUEPRINTS') AS print,
      e.part_id IN (SELECT part_id FROM tags WHERE keyword = 'RESEARCH EQUIPMENT') AS research,
      e.good_id IN (SELECT part_id FROM tags WHERE keyword IN ('SUBSYSTEMS','STRATEGIC CRUISERS','BOOSTER')) AS no_pos
      FROM edges e JOIN parts g ON g.part_id = e.good_id))"""
CTES["paths"] = """SELECT good_id AS produce_id, good_id, part_id, 1 AS depth, [good_id, part_id] AS nodes,
    [CASE WHEN round_kind = 'NONE' THEN -factor12 ELSE factor12 END] AS fs,
    CASE WHEN raw THEN 'FLOOR' ELSE 'CEIL' END AS kind,
    part_id NOT IN (SELECT good_id FROM edges) AS leaf
  FROM rates
  UNION ALL
  SELECT p.produce_id, r.good_id, r.part_id, p.depth + 1, list_append(p.nodes, r.part_id),
    list_append(p.fs, CASE WHEN round_kind = 'NONE' THEN -factor12 ELSE factor12 END),
    CASE WHEN raw THEN 'FLOOR' ELSE 'CEIL' END, r.part_id NOT IN (SELECT good_id FROM edges)
  FROM paths p JOIN rates r ON r.good_id = p.part_id"""
CTES["regions"] = "SELECT r_regionkey::BIGINT AS region, r_name AS name_region FROM region"
CTES["local"] = "SELECT region FROM regions WHERE instr('AMERICA ASIA EUROPE', name_region) > 0"
CTES["orders_"] = """SELECT l_partkey AS part_id, CASE WHEN l_linestatus = 'O' THEN 'SELL' ELSE 'BUY' END AS direction,
  n_name AS system_name, n_regionkey::BIGINT AS region,
  round(l_extendedprice*100/l_quantity)::BIGINT AS price, l_quantity::BIGINT AS quantity,
  l_linenumber::BIGINT AS min_qty, l_shipdate::DATE + 30 AS expires, l_shipdate AS stamp,
  l_orderkey, l_suppkey, l_linenumber
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey"""


def depth(source: str) -> str:
    sell, buy = PARAMS.supply_depth, PARAMS.demand_depth
    limit = PARAMS.spread_overshoot
    return f"""SELECT * FROM (
  SELECT part_id, direction, region, sum(quantity)::BIGINT AS samples, min(top)::BIGINT AS price_top,
    {half_up('sum(price*quantity)', 'sum(quantity)')}::BIGINT AS price_average
  FROM (SELECT *, first_value(price) OVER w AS top, coalesce(sum(price*quantity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
    FROM {source} WINDOW w AS (PARTITION BY part_id, direction, region ORDER BY CASE WHEN direction='SELL' THEN price ELSE -price END, quantity))
  WHERE CASE WHEN direction='SELL' THEN prior < {sell} AND price <= {limit}*top ELSE prior < {buy} AND price*100 >= {limit}*top END
  GROUP BY ALL) WHERE direction = 'BUY' OR price_average*samples > {PARAMS.notable_supply}"""


CTES["aggregates"] = depth("orders_")
CTES["sells"] = """SELECT part_id, direction, samples, price_top AS lowest_offer, price_average AS offers_low_range, region, name_region
  FROM aggregates JOIN regions USING (region) WHERE direction = 'SELL'"""
CTES["buys"] = """SELECT part_id, direction, samples, price_top AS highest_bid, price_average AS bids_high_range, region, name_region
  FROM aggregates JOIN regions USING (region) WHERE direction = 'BUY'"""
CTES["best_any"] = """SELECT part_id, region, name_region, offers_low_range AS price FROM sells
  QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY offers_low_range, region) = 1"""
CTES["best_local"] = """SELECT part_id, region, name_region, offers_low_range AS price FROM sells WHERE region IN (SELECT region FROM local)
  QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY offers_low_range, region) = 1"""
CTES["spread"] = """SELECT s.part_id, s.region, s.name_region, s.samples AS sells, lowest_offer, offers_low_range,
  b.samples AS buys, highest_bid, bids_high_range FROM sells s JOIN buys b USING (part_id, region)"""
CTES["hub"] = f"""SELECT part_id, ((2*(min(lowest_offer)+max(highest_bid))+2)//4)::BIGINT AS mid_spread_hub FROM spread
  WHERE region = {PARAMS.hub_region} GROUP BY part_id"""
CTES["buildable"] = f"""SELECT * FROM parts WHERE part_id NOT IN {tagged('ORE')} AND part_id NOT IN {tagged('BLUEPRINTS')}
  AND part_id NOT IN (SELECT good_id FROM edges WHERE part_id IN {tagged('CONTRACTS')})"""
CTES["breakeven"] = f"""SELECT produce_id, label AS produce, units AS outcome_units,
  {half_up('total*10506', 'units*10000')}::BIGINT AS break_micro FROM (
  SELECT produce_id, g.label, g.units, sum(b.price * {six(fold(f'g.units::HUGEINT*{M12}'))}) AS total
  FROM paths JOIN buildable g ON g.part_id = produce_id JOIN best_local b ON b.part_id = paths.part_id
  WHERE leaf GROUP BY ALL)"""
CTES["breakeven_any"] = CTES["breakeven"].replace("best_local", "best_any")
CTES["list_units"] = """SELECT l_partkey AS item, arg_min(units, l_orderkey) AS units FROM lineitem JOIN (
  SELECT l_orderkey, max(l_quantity)::BIGINT AS units FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part) GROUP BY l_orderkey)
  USING (l_orderkey) GROUP BY l_partkey"""
CTES["demand"] = f"""SELECT part_id, sum({six(fold(f'l.units::HUGEINT*{M12}'))}) AS u_orig, sum({q_copy('l.units', 4)}) AS u_copy
  FROM paths JOIN list_units l ON l.item = good_id GROUP BY part_id"""
CTES["rebuilt"] = f"""SELECT paths.part_id, sum({six(fold('d.u_orig*1000000'))}) AS quantity_orig, sum({six(fold('d.u_copy*1000000'))}) AS quantity
  FROM paths JOIN demand d ON d.part_id = produce_id GROUP BY paths.part_id"""
CTES["asset_docs"] = """SELECT c_mktsegment AS holder, o_orderkey, o_custkey, o_orderdate, o_orderstatus,
  o_orderkey % 5 + 60000000 AS location_id, ['12753','12747','28844','20189'][o_orderkey % 4 + 1] AS location_type,
  o_custkey*3+7 AS item1, o_orderkey % 50 + 1 AS n1, o_orderkey*3+7 AS item2, o_orderkey % 9 + 1 AS n2
  FROM orders JOIN customer ON c_custkey = o_custkey"""
CTES["assets"] = """SELECT holder, location_id::VARCHAR AS location_id, location_type, item::VARCHAR AS item_type, quantity FROM (
  SELECT holder, location_id, location_type, item1 AS item, n1 AS quantity FROM asset_docs UNION ALL
  SELECT holder, location_id, location_type, item2, n2 FROM asset_docs)
  WHERE item IN (SELECT external_id FROM parts)"""
CTES["counted"] = """SELECT holder, item_type, quantity FROM assets WHERE (holder = 'BUILDING' AND location_id = '60000003')
  OR (holder = 'MACHINERY' AND location_type IN ('12753','12747','20189'))"""
CTES["quotes"] = """SELECT l_partkey AS item_type_id, d.direction, l_orderkey AS order_id, region, l_suppkey::VARCHAR AS station,
  system_name || ' IV - Dock ' || l_suppkey AS station_name, system_name, (l_suppkey % 15 - 4)/10.0::DOUBLE AS security,
  CASE WHEN d.direction = 'SELL' THEN price ELSE price*9//10 END AS price, quantity, min_qty, expires
  FROM (SELECT *, part_id AS l_partkey FROM orders_) o, (VALUES ('SELL'),('BUY')) d(direction)"""
CTES["print_labels"] = "SELECT p_partkey AS part_id, CASE WHEN p_type = 'PROMO' THEN {pick} WHEN p_type = 'SMALL' THEN upper(p_name) || ' - BLUEPRINT COPY' ELSE upper(p_name) END AS label FROM part"


def _quoted(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


_labels = [*tag_rules.BOUGHT_ON_CONTRACT, *tag_rules.INVENTED, *tag_rules.INVENTED_UNTAGGED, *tag_rules.REVERSE_ENGINEERED]
CTES["print_labels"] = CTES["print_labels"].replace("{pick}", f"[{_quoted(_labels)}][p_partkey % {len(_labels)} + 1]")
CTES["looped"] = """SELECT good_id, part_id FROM edges UNION
  SELECT part_id, good_id FROM edges WHERE edge_id % 10 = 1 AND good_id IN (SELECT part_id FROM parts WHERE p_size = 50) UNION
  SELECT b.part_id, a.good_id FROM edges a JOIN edges b ON b.good_id = a.part_id
  WHERE a.edge_id % 10 = 1 AND b.edge_id % 10 <= 2 AND a.good_id IN (SELECT part_id FROM parts WHERE p_size BETWEEN 44 AND 49)"""
CTES["doc_text"] = """SELECT o_custkey AS item, o_orderstatus, timezone('UTC', timezone('Europe/London', o_orderdate)) AS cached_until,
  '<holdings><result><rowset><row locationID="' || location_id || '" typeID="' || location_type || '"><rowset><row typeID="' || item1 ||
  '" quantity="' || n1 || '"/><row typeID="' || item2 || '" quantity="' || n2 ||
  '"/></rowset></row><row locationID="1" typeID="2"/></rowset></result><cachedUntil>' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') ||
  '</cachedUntil></holdings>' AS xdoc FROM asset_docs"""
CTES["docs_old"] = "SELECT item, cached_until, xdoc FROM doc_text WHERE o_orderstatus = 'F' QUALIFY row_number() OVER (PARTITION BY item ORDER BY cached_until DESC, xdoc DESC) = 1"
CTES["docs_new"] = CTES["docs_old"].replace("'F'", "'O'")
CTES["early"] = "SELECT * FROM orders_ WHERE stamp < TIMESTAMP '1998-01-01'"
CTES["large"] = "SELECT * FROM orders_ WHERE quantity > 20"
CTES["old_prices"] = depth("early")
CTES["new_prices"] = depth("large")
CTES["broken"] = "SELECT *, CASE WHEN p_size <> 49 THEN vol_milli END AS volume FROM parts WHERE p_size <> 50"
CTES["twice"] = "SELECT * FROM edges UNION ALL SELECT * FROM edges WHERE qty100 = 500"
CTES["cheap"] = "SELECT part_id, direction, region, price - 20000 AS price, CASE WHEN quantity <> 7 THEN quantity END AS quantity, min_qty FROM orders_"
CTES["walk"] = """SELECT part_id, direction, region, price, quantity, price AS top,
    row_number() OVER (PARTITION BY part_id, direction, region ORDER BY CASE WHEN direction='SELL' THEN price ELSE -price END, quantity) AS rn
  FROM orders_"""
_step_avg = "((2*(s.average*s.samples + w.price*w.quantity) + s.samples + w.quantity) // (2*(s.samples + w.quantity)))"
CTES["steps"] = f"""SELECT part_id, direction, region, price AS top, quantity AS samples, price AS average, rn FROM walk WHERE rn = 1
  UNION ALL
  SELECT s.part_id, s.direction, s.region, s.top, s.samples + w.quantity, {_step_avg}, w.rn
  FROM steps s JOIN walk w ON w.part_id = s.part_id AND w.direction = s.direction AND w.region = s.region AND w.rn = s.rn + 1
  WHERE CASE WHEN s.direction='SELL' THEN w.price <= {PARAMS.spread_overshoot}*s.top AND s.average*s.samples < {PARAMS.supply_depth}
    ELSE w.price*100 >= {PARAMS.spread_overshoot}*s.top AND s.average*s.samples < {PARAMS.demand_depth} END"""
CTES["stream_orders"] = """SELECT item_type_id AS part_id, direction, region, price, quantity FROM quotes
  WHERE security >= 0.5 AND expires::TIMESTAMP > TIMESTAMP '1998-06-03 12:30:17'"""

ITER = {"paths", "steps"}
_NEEDS = {name: [w for w in CTES if w != name and re.search(rf"\b{w}\b", body)] for name, body in CTES.items()}


def sql(body: str) -> str:
    """The body with just the common table expressions it needs, in definition order."""
    wanted: set[str] = set()

    def add(text_names):
        for name in text_names:
            if name not in wanted:
                wanted.add(name)
                add(_NEEDS[name])

    add([w for w in CTES if re.search(rf"\b{w}\b", body)])
    if not wanted:
        return body
    # ``orders`` the base table is never shadowed: the derived order book is ``orders_``
    ctes = ",\n".join(
        f"{name} AS {'' if name in ITER else 'MATERIALIZED '}({CTES[name]})" for name in CTES if name in wanted)
    return f"WITH RECURSIVE {ctes}\n{body}"


VOLUME = "(vol_milli/1000.0)::DOUBLE"
SHORT6 = "CASE WHEN quantity - pile*1000000 > 0 THEN quantity - pile*1000000 END"


def cargo(volume_milli: str, quantity6: str, capacity: int, decimals: int) -> str:
    n = f"({volume_milli})::HUGEINT*({quantity6})*{100 * 10**decimals}"
    micro = half_up(n, f"{capacity}000000000::HUGEINT")
    return f"({micro}::BIGINT / 1e{decimals})"


def material_report(source: str, best: str, quoted_rule: str, total_quantity: str, capacity: int, extra: str, keyword: str,
                    params: str, where: str = "") -> str:
    loaded = f"sum(vol_milli::HUGEINT*{total_quantity})"
    return f"""SELECT {params} AS params, {keyword} AS keyword, {initcap('label')} AS part, {as_double('quantity_orig')} AS quantity_orig,
  {as_double('quantity')} AS quantity, pile, {as_double('short')} AS shop_list, price AS quote, {initcap('name_region')} AS region,
  {as_double('sum(price*short) OVER ()')} AS items_tot, {cargo('vol_milli', 'short', PARAMS.deep_transport_m3, 2)} AS item_dst_cargo,
  ({half_up(f'{loaded} OVER () * 1000', f'{capacity}000000000::HUGEINT')}::BIGINT / 1e1) AS total_dst_cargo{extra}
  FROM (SELECT m.*, p.label, p.vol_milli, p.pile, b.price, b.name_region, {SHORT6} AS short
    FROM ({source}) m JOIN parts p USING (part_id) LEFT JOIN {best} b USING (part_id)
    WHERE {quoted_rule} {where})"""


LISTS = "(SELECT count(DISTINCT l_orderkey) || ' lists' FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part))"
T13 = "(b.part_id IS NOT NULL OR m.part_id NOT IN (SELECT part_id FROM sells))"
BUILD_Q = f"""SELECT part_id, sum({six(fold(f'l.units::HUGEINT*{M12}'))}) AS quantity_orig, sum({{copy}}) AS quantity
  FROM paths JOIN list_units l ON l.item = produce_id {{filter}} GROUP BY part_id"""
JOB = (f", CASE WHEN part_id IN {tagged('COMPONENTS')} AND short > 0 THEN format('{{:,}}', {half_up('short', '1000000')}::BIGINT) || '  ' || "
       f"{initcap('label')} END AS job_list")
YIELD = f"""SELECT paths.good_id, o.label AS ore, paths.part_id, p.label AS mineral,
  {six(fold(f'{half_up(f"1000000::HUGEINT*{M12}", "o.vol_milli")}'))} AS rep6, b.bids_high_range AS bid, b.name_region
  FROM paths JOIN parts o ON o.part_id = paths.good_id AND o.part_id IN {tagged('ORE')}
  JOIN parts p ON p.part_id = paths.part_id JOIN buys b ON b.part_id = paths.part_id"""
VALUE = "((2*bid*rep6 + 100000000)//200000000)*100"
READABLE = "regexp_replace({x}, '^([^ ]*) (.*)$', '\\2, \\1')"


def margin_report(best: str, local: str, adjust: int, where: str) -> str:
    asked = f"((lowest_offer+highest_bid)*100 + (lowest_offer-highest_bid)*({adjust}))"
    share = f"(greatest({asked}*5000, mid_spread_hub*1000000)::HUGEINT - break_micro)"
    return f"""SELECT {initcap('produce')} AS produce, {initcap('name_region')} AS region, sells, lowest_offer, offers_low_range, buys,
  highest_bid, bids_high_range, (lowest_offer+highest_bid)/2.0::DOUBLE AS mid_spread, {adjust} AS adj,
  {as_double(f'{asked}*5000')} AS my_adjusted_offer, mid_spread_hub AS mid_spread_jita, {as_double('break_micro')} AS break,
  buys*bids_high_range AS demand,
  CASE WHEN mid_spread_hub IS NOT NULL THEN {half_up_signed(f'({share}*1000)', 'break_micro')}::BIGINT / 1e1 END AS margin
  FROM {best} JOIN spread s ON s.part_id = produce_id LEFT JOIN hub h ON h.part_id = produce_id
  WHERE {local} {where}"""


O: dict[str, str] = {}

# --- sources
O["csv_catalogue_parts"] = f"""SELECT label, path AS market_browser_path, {VOLUME} AS volume, external_id, me::DOUBLE AS material_efficiency,
  units AS outcome_units FROM parts WHERE part_id % 17 <> 3"""
O["csv_rejected_lines"] = "SELECT label FROM parts WHERE part_id % 17 = 3"
O["csv_catalogue_bom"] = "SELECT good, part, (qty100/100.0)::DOUBLE AS quantity FROM edges"
O["staging_filter"] = "SELECT upper(p_name) AS label, p_partkey FROM part WHERE p_size <> 13"
_quote_cols = "item_type_id, order_id, region, station, station_name, security, price, quantity, min_qty, expires"
O["xml_orders_sell"] = f"SELECT {_quote_cols} FROM quotes WHERE direction = 'SELL'"
O["xml_orders_buy"] = f"SELECT {_quote_cols} FROM quotes WHERE direction = 'BUY'"
O["orders_in_regions"] = f"SELECT {_quote_cols}, direction FROM quotes WHERE region IN (1, 3)"
O["orders_rejected"] = """SELECT item_type_id, '3 not well-formed, 4 no document, 5 unreadable price' AS refused, count(*) AS orders,
  sum(price)::BIGINT AS cents FROM quotes GROUP BY item_type_id"""
O["xml_assets_nested"] = "SELECT holder, location_id, location_type, item_type, quantity FROM assets"
O["xml_jobs"] = """SELECT o_orderkey::VARCHAR AS job_id, 'Clerk ' || o_custkey % 100 AS installer_name, 8 AS activity_id,
  (o_orderkey+1)::VARCHAR AS blueprint_id, o_custkey::VARCHAR AS blueprint_type_id, 'Print ' || o_custkey AS blueprint_type_name,
  o_orderkey % 7 + 1 AS runs, o_orderkey % 3 + 1 AS licensed_runs, ((o_orderkey % 4 + 2)/10.0)::DOUBLE AS probability,
  o_custkey*3+7 AS product_type_id, 'Thing ' || o_custkey AS product_type_name,
  timezone('UTC', timezone('Europe/London', o_orderdate)) AS date_end FROM orders"""
O["xml_cached_until"] = """SELECT o_orderkey, timezone('Asia/Tokyo', timezone('Europe/London', o_orderdate)) AS cached_until FROM orders"""

# --- upserts
O["upsert_regions"] = f"""SELECT r_regionkey::BIGINT AS region, r_name AS name_region FROM region UNION ALL
  SELECT * FROM (SELECT * FROM (VALUES {", ".join(f"({i}, '{n}')" for i, n in REGIONS)}) v(region, name_region)
    UNION ALL SELECT n_nationkey, n_name FROM nation) WHERE region NOT IN (SELECT r_regionkey FROM region)"""
O["upsert_parts"] = """SELECT label, external_id, ((vol_milli + CASE WHEN p_size > 40 THEN 1000 ELSE 0 END)/1000.0)::DOUBLE AS volume,
  (CASE WHEN p_size = 7 THEN 0 ELSE me END)::DOUBLE AS material_efficiency, CASE WHEN p_type = 'LARGE' THEN 1 ELSE units END AS outcome_units,
  CASE WHEN p_type <> 'SMALL' THEN pile END AS pile FROM parts"""
O["upsert_bom"] = """SELECT good_id, part_id, good, part, ((qty100 + CASE WHEN qty100 > 200 THEN 100 ELSE 0 END)/100.0)::DOUBLE AS quantity FROM edges"""
O["keyword_explode"] = "SELECT part_id, keyword FROM tags"
O["keyword_dictionary"] = "SELECT keyword, count(*) AS parts, 1::BIGINT AS ids FROM tags GROUP BY keyword"
_rule_sql = " UNION ".join(
    f"SELECT part_id, '{k}' AS keyword FROM print_labels WHERE label IN ({_quoted(r.labels)})"
    + "".join(" OR (" + " AND ".join(f"label LIKE '%{x}%'" for x in every) + ")" for every in r.all_of)
    for r in tag_rules.RULES for k in r.keywords)
O["keyword_rules"] = _rule_sql
O["tag_union_distinct"] = f"""SELECT part_id FROM print_labels WHERE label LIKE '% - %' AND label LIKE '%BLUEPRINT COPY%'
  UNION SELECT part_id FROM print_labels WHERE label IN ({_quoted(tag_rules.REVERSE_ENGINEERED)})"""
_doc_merge = """SELECT coalesce(o.item, n.item) AS item, CASE WHEN {take} THEN n.cached_until ELSE o.cached_until END AS cached_until,
  CASE WHEN {take} THEN n.xdoc ELSE o.xdoc END AS xdoc FROM docs_old o FULL JOIN docs_new n ON n.item = o.item"""
O["asset_cache_upsert"] = _doc_merge.replace("{take}", "o.item IS NULL OR n.cached_until > o.cached_until")
O["market_cache_upsert"] = _doc_merge.replace("{take}", "n.item IS NOT NULL")
O["assets_union_all"] = "SELECT holder, item_type, quantity FROM counted"
O["stock_left_zero"] = """SELECT part_id, coalesce(held, 0)::BIGINT AS pile FROM parts LEFT JOIN
  (SELECT item_type::BIGINT AS external_id, sum(quantity) AS held FROM counted GROUP BY ALL) USING (external_id) WHERE external_id IS NOT NULL"""
O["stock_upsert"] = """SELECT part_id, label, CASE WHEN external_id IS NULL THEN pile ELSE coalesce(held, 0) END::BIGINT AS pile FROM parts LEFT JOIN
  (SELECT item_type::BIGINT AS external_id, sum(quantity) AS held FROM counted WHERE holder = 'MACHINERY' GROUP BY ALL) USING (external_id)"""
O["snapshot_replace"] = """SELECT part_id, direction, region, price, quantity FROM orders_ WHERE part_id NOT IN (SELECT part_id FROM parts WHERE p_size > 25)
  UNION ALL SELECT part_id, direction, region, price + 1, quantity FROM orders_
  WHERE direction = 'SELL' AND part_id IN (SELECT part_id FROM parts WHERE p_size > 25)"""
O["price_upsert"] = """SELECT coalesce(o.part_id, n.part_id) AS part_id, coalesce(o.direction, n.direction) AS direction,
  coalesce(o.region, n.region) AS region, coalesce(n.samples, o.samples) AS samples, coalesce(n.price_top, o.price_top) AS price_top,
  coalesce(n.price_average, o.price_average) AS price_average,
  CASE WHEN n.part_id IS NULL OR (n.samples = o.samples AND n.price_top = o.price_top AND n.price_average = o.price_average)
    THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2020-02-01' END AS time_quotes_exec
  FROM old_prices o FULL JOIN new_prices n ON n.part_id = o.part_id AND n.direction = o.direction AND n.region = o.region"""
O["local_region_set"] = "SELECT region FROM local"

# --- projections, checks
O["bom_detail"] = f"""SELECT edge_id, good_id, good, {VOLUME} AS volume, me::DOUBLE AS material_efficiency, units AS outcome_units, pile, external_id,
  e.part_id, part, (qty100/100.0)::DOUBLE AS quantity FROM edges e JOIN parts g ON g.part_id = good_id"""
O["sells_by_region"] = f"SELECT * FROM sells"
O["buys_by_region"] = f"SELECT * FROM buys"
O["order_relevance"] = """SELECT item_type_id, direction, system_name, region, price, quantity, min_qty, expires FROM quotes
  WHERE security >= 0.5 AND expires::TIMESTAMP > TIMESTAMP '1998-06-03 12:30:17'"""
O["stale_items"] = """SELECT part_id, external_id, cached_until, item_no, ((2*item_no+5)//10)::BIGINT AS batch FROM (
  SELECT p.part_id, external_id, cached_until, row_number() OVER (ORDER BY external_id) AS item_no
  FROM parts p LEFT JOIN (SELECT l_partkey, max(l_shipdate) AS cached_until FROM lineitem GROUP BY 1) c
    ON c.l_partkey = p.part_id AND p.p_brand <> 'Brand#1'
  WHERE external_id IS NOT NULL AND (cached_until IS NULL OR cached_until < TIMESTAMP '2001-08-15')
  AND p.part_id NOT IN (SELECT part_id FROM tags WHERE keyword IN ('CONTRACTS', 'BLUEPRINTS')))"""
_qty = "(qty100/100.0)::DOUBLE AS quantity_raw, {s} AS quantity_true_station, {p} AS quantity_true_pos".format(
    s=as_double("qty100*station4"), p=as_double("qty100*pos4"))
O["where_used"] = f"SELECT good, part, {_qty} FROM rates WHERE part LIKE '%WIDGET%'"
O["browse_produce"] = """SELECT r.label AS produce, g.label AS good, p.label AS part, depth, leaf FROM paths JOIN parts r ON r.part_id = produce_id
  JOIN parts g ON g.part_id = paths.good_id JOIN parts p ON p.part_id = paths.part_id
  WHERE produce_id = (SELECT min(part_id) FROM parts)"""
O["distinct_goods"] = "SELECT DISTINCT good FROM edges"
O["keyword_exclusion"] = """SELECT part_id, label, me::DOUBLE AS material_efficiency FROM parts WHERE me < 10 AND me <> 4 AND part_id NOT IN
  (SELECT part_id FROM tags WHERE keyword IN ('BLUEPRINTS','BOOSTER','MATERIALS','RESEARCH EQUIPMENT','CONTRACTS'))"""
O["remaining_count"] = "SELECT part_id, count(*) OVER () AS remain FROM parts WHERE external_id IS NOT NULL"
O["has_keyword"] = "SELECT part_id FROM tags WHERE keyword = 'COMPONENTS'"
O["dup_label_check"] = "SELECT upper(p_name) AS label, count(*) AS copies FROM part GROUP BY 1 HAVING count(*) > 1"
O["dup_extid_check"] = """SELECT external_id, count(*) AS copies FROM (SELECT CASE WHEN p_type = 'PROMO' THEN p_partkey // 2
  WHEN p_type <> 'SMALL' THEN p_partkey*3 + 1000000007 END AS external_id FROM part) WHERE external_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""
O["self_loop_check"] = "SELECT edge_id, good, good AS part FROM edges WHERE qty100 = 300"
O["bom_cycles"] = """WITH RECURSIVE looped AS MATERIALIZED ({looped}), reach AS (
    SELECT good_id AS a, part_id AS b FROM looped
    UNION SELECT a, part_id FROM reach JOIN looped ON good_id = b),
  member AS MATERIALIZED (SELECT a AS node, min(b) AS root FROM reach r WHERE (b, a) IN (SELECT a, b FROM reach) GROUP BY a),
  inner_edges AS MATERIALIZED (SELECT good_id, part_id, g.root FROM looped JOIN member g ON g.node = good_id JOIN member p ON p.node = part_id
    WHERE g.root = p.root),
  to_root AS (SELECT root AS node, root, [root] AS walk FROM (SELECT DISTINCT root FROM member)
    UNION SELECT good_id, t.root, list_prepend(good_id, walk) FROM to_root t JOIN inner_edges e ON e.part_id = t.node AND e.root = t.root
      WHERE NOT list_contains(walk, good_id)),
  from_root AS (SELECT root AS node, root, [root] AS walk FROM (SELECT DISTINCT root FROM member)
    UNION SELECT part_id, f.root, list_append(walk, part_id) FROM from_root f JOIN inner_edges e ON e.good_id = f.node AND e.root = f.root
      WHERE NOT list_contains(walk, part_id)),
  best_to AS (SELECT node, min(list_prepend(len(walk), walk))[2:] AS walk FROM to_root GROUP BY node),
  best_from AS (SELECT node, min(list_prepend(len(walk), walk))[2:] AS walk FROM from_root GROUP BY node)
  SELECT good_id, part_id, array_to_string(list_concat(list_prepend(good_id, t.walk), f.walk[2:]), '>') AS path
  FROM inner_edges JOIN best_to t ON t.node = part_id JOIN best_from f ON f.node = good_id"""
O["orphan_edges"] = """SELECT good, part, 'good' AS side, good AS missing FROM edges WHERE good_id IN (SELECT part_id FROM parts WHERE p_type = 'SMALL')
  UNION ALL SELECT good, part, 'part', part FROM edges WHERE part_id IN (SELECT part_id FROM parts WHERE p_type = 'SMALL')"""
O["region_conflicts"] = """WITH r AS (SELECT r_regionkey::BIGINT AS region, r_name AS name_region FROM region
    UNION ALL SELECT n_nationkey, n_name FROM nation
    UNION ALL SELECT s_suppkey + 1000, 'DEPOT ' || trunc(s_acctbal)::INT FROM supplier)
  SELECT DISTINCT a.region, a.name_region FROM r a JOIN r b
  ON (a.region = b.region AND a.name_region <> b.name_region) OR (a.region <> b.region AND a.name_region = b.name_region)"""
O["aggregates_without_orders"] = "SELECT * FROM aggregates WHERE part_id NOT IN (SELECT part_id FROM orders_ WHERE quantity > 48)"
O["constraint_violations"] = """SELECT 'part.volume not null' AS rule, part_id::VARCHAR AS key, 'volume' AS detail FROM broken WHERE volume IS NULL
  UNION ALL SELECT 'edge unique', good_id::VARCHAR, part_id::VARCHAR FROM twice GROUP BY good_id, part_id HAVING count(*) > 1
  UNION ALL SELECT 'edge.good_id in catalogue', edge_id::VARCHAR, good_id::VARCHAR FROM twice WHERE good_id NOT IN (SELECT part_id FROM broken)
  UNION ALL SELECT 'edge.part_id in catalogue', edge_id::VARCHAR, part_id::VARCHAR FROM twice WHERE part_id NOT IN (SELECT part_id FROM broken)
  UNION ALL SELECT 'tag.part_id in catalogue', part_id::VARCHAR, keyword FROM tags
    WHERE keyword <> 'STRATEGIC CRUISERS' AND part_id NOT IN (SELECT part_id FROM broken)
  UNION ALL SELECT 'tag.part_id not null', NULL, 'part_id' FROM tags WHERE keyword = 'STRATEGIC CRUISERS'
  UNION ALL SELECT 'region.name_region not null', '2', 'name_region'
  UNION ALL SELECT 'order.quantity not null', part_id::VARCHAR, 'quantity' FROM cheap WHERE quantity IS NULL
  UNION ALL SELECT 'aggregate.samples not null', part_id::VARCHAR, 'samples' FROM aggregates WHERE samples % 10 = 0
  UNION ALL SELECT 'order.part_id in catalogue', part_id::VARCHAR, direction FROM cheap WHERE part_id NOT IN (SELECT part_id FROM broken)
  UNION ALL SELECT 'order.region known', part_id::VARCHAR, region::VARCHAR FROM cheap WHERE region = 4
  UNION ALL SELECT 'aggregate.part_id in catalogue', part_id::VARCHAR, direction FROM aggregates WHERE part_id NOT IN (SELECT part_id FROM broken)
  UNION ALL SELECT 'aggregate.region known', part_id::VARCHAR, region::VARCHAR FROM aggregates WHERE region = 4
  UNION ALL SELECT 'order.price positive', part_id::VARCHAR, price::VARCHAR FROM cheap WHERE price <= 0"""

_loaded = """SELECT good_id, good, qty100, CASE WHEN qty100 = 400 THEN 'NO ' || part WHEN qty100 = 300 THEN good ELSE part END AS part FROM edges
  UNION ALL SELECT good_id, good, qty100, part FROM edges WHERE qty100 = 500"""
O["load_violations"] = f"""SELECT 'duplicate label' AS rule, label AS key, '2' AS detail FROM parts WHERE part_id % 50 = 0
  UNION ALL SELECT 'duplicate external id', external_id::VARCHAR, '2' FROM parts WHERE part_id % 50 = 0 AND external_id IS NOT NULL
  UNION ALL SELECT 'good equals part', good, part FROM ({_loaded}) WHERE good = part
  UNION ALL SELECT 'not in catalogue', part, good FROM ({_loaded}) WHERE part LIKE 'NO %'
  UNION ALL SELECT 'edge loaded twice', good, part FROM ({_loaded}) GROUP BY good, part HAVING count(*) > 1"""
O["refused_edges"] = f"""SELECT good, part, (qty100/100.0)::DOUBLE AS quantity, CASE WHEN part LIKE 'NO %' THEN 'part not in catalogue'
    WHEN part = good THEN 'good equals part' ELSE 'edge loaded twice' END AS reason FROM ({_loaded}) WHERE qty100 IN (300, 400, 500)
  UNION ALL SELECT good, part, (qty100/100.0)::DOUBLE, 'stored' FROM edges WHERE qty100 NOT IN (300, 400, 500)"""

# --- market
O["order_depth_average"] = "SELECT * FROM aggregates"
O["order_depth_hot_groups"] = "SELECT * FROM aggregates"
O["order_depth_exact_steps"] = f"""SELECT part_id, direction, region, samples::BIGINT AS samples, top AS price_top, average::BIGINT AS price_average FROM steps
  WHERE direction = 'BUY' OR average*samples > {PARAMS.notable_supply}
  QUALIFY row_number() OVER (PARTITION BY part_id, direction, region ORDER BY rn DESC) = 1"""
O["econ_region"] = "SELECT part_id, region, price AS price_average FROM best_local"
O["econ_region_buy"] = """SELECT part_id, region, price_average FROM aggregates WHERE direction = 'BUY'
  QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY price_average DESC, region) = 1"""
O["local_semi"] = "SELECT * FROM aggregates WHERE region IN (SELECT region FROM local)"
O["orders_stream"] = depth("stream_orders")
O["cart_total"] = """SELECT part_id, region, samples, offers_low_range, (sum(samples*offers_low_range) OVER ())::BIGINT AS items_tot FROM sells"""

# --- bills of materials
O["bom_rates"] = f"""SELECT edge_id, base4/1e4 AS consume_rate_base, station4/1e4 AS consume_rate_true_station, pos4/1e4 AS consume_rate_true_pos,
  round_kind, {as_double(half_up('factor12', '1000000'))} AS factor FROM rates"""
O["bom_quantities"] = f"SELECT edge_id, good, part, {_qty} FROM rates"
O["bom_explode"] = "SELECT produce_id, good_id, part_id, depth, leaf, array_to_string(nodes, '>') AS path FROM paths"
_num = "regexp_replace(regexp_replace((abs(f) // 1000000000000)::VARCHAR || '.' || lpad((abs(f) % 1000000000000)::VARCHAR, 12, '0'), '0+$', ''), '\\.$', '')"
O["bom_formula"] = f"""SELECT array_to_string(nodes, '>') AS path, list_reduce(list_prepend(':UNITS', list_transform(fs, lambda f:
  CASE WHEN f < 0 THEN '-' ELSE '+' END || {_num})), lambda a, f: CASE WHEN f[1] = '-' THEN a || ' * ' || f[2:]
  ELSE kind || '(' || a || ' * ' || f[2:] || ')' END) AS formula_bp_orig FROM paths"""
O["bom_evaluate"] = f"SELECT array_to_string(nodes, '>') AS path, {as_double(six(fold(f'9::HUGEINT*{M12}')))} AS quantity FROM paths"
O["bom_copy_runs"] = f"""SELECT array_to_string(nodes, '>') AS path, {as_double(six(fold(f'25::HUGEINT*{M12}')))} AS q_orig,
  {as_double(q_copy('25', 4))} AS q_copy FROM paths"""
O["leaf_paths"] = "SELECT produce_id, good_id, part_id, depth FROM paths WHERE leaf"

# --- report building blocks
O["no_contract_parts"] = "SELECT part_id, label FROM buildable"
O["sell_buy_spread"] = "SELECT * FROM spread"
O["best_universe_price"] = "SELECT part_id, price AS best_price, name_region AS best_region FROM best_any"
O["compare_region_price"] = """SELECT part_id, offers_low_range AS here_price, name_region AS here_region FROM sells WHERE name_region LIKE '%I%'
  QUALIFY row_number() OVER (PARTITION BY part_id ORDER BY region) = 1"""
O["hub_mid_spread"] = "SELECT part_id, mid_spread_hub FROM hub"
O["buy_it_price"] = "SELECT part_id, price AS buy_price FROM best_local"
O["product_breakeven"] = "SELECT produce_id, produce, outcome_units, break_micro FROM breakeven"
O["component_demand"] = f"SELECT part_id, {as_double('u_orig')} AS units_orig, {as_double('u_copy')} AS units_copy FROM demand"
O["components_rebuild"] = f"SELECT part_id, {as_double('quantity_orig')} AS quantity_orig, {as_double('quantity')} AS quantity FROM rebuilt"
O["ore_value"] = f"SELECT good_id, sum({VALUE})::BIGINT AS value_index FROM ({YIELD}) GROUP BY good_id"
_cost_rows = """SELECT produce_id, r.label AS produce, p.label AS part, p.part_id, p.vol_milli, p.pile, b.price, b.name_region, quantity, x.price AS buy_price
  FROM (SELECT produce_id, part_id, sum({q}) AS quantity FROM paths WHERE leaf GROUP BY ALL) m JOIN parts p USING (part_id)
  JOIN parts r ON r.part_id = produce_id {rlike} LEFT JOIN {best} b ON b.part_id = m.part_id LEFT JOIN {best} x ON x.part_id = produce_id
  WHERE (b.part_id IS NOT NULL OR m.part_id NOT IN (SELECT part_id FROM sells))"""
_tot = "sum(price*quantity) OVER (PARTITION BY produce_id)"
O["cost_share"] = f"""SELECT produce_id, part_id, {half_up('price*quantity*100', 'nullif(total, 0)')}::BIGINT AS pct, ({half_up('total', '100000000')}*100)::BIGINT AS goods_tot
  FROM (SELECT *, {_tot} AS total FROM ({_cost_rows.format(q=six(fold(f'10::HUGEINT*{M12}')), rlike='', best='best_any')}))"""
O["parse_build_list"] = """SELECT p_partkey, label, units FROM (
  SELECT p_partkey, upper(p_name) AS label, p_size::BIGINT AS units FROM part UNION ALL
  SELECT p_partkey, p_partkey::VARCHAR, p_size FROM part UNION ALL
  SELECT p_partkey, 'LAST', CASE WHEN p_size % 2 = 0 THEN p_size + 1 END FROM part)"""
O["build_units_of_lists"] = "SELECT item::BIGINT AS part_id, units::BIGINT AS units FROM list_units WHERE item IN (SELECT part_id FROM parts)"
_cents = "round(p_retailprice*100)::BIGINT"
_low = f"({_cents}*7//9)"
O["per_cent"] = f"""SELECT part_id, CASE WHEN pile IS NULL THEN NULL WHEN pile % 7 = 0 THEN 0.0::DOUBLE
    ELSE {half_up_signed('((pile - 250)*1000)', '(nullif(pile % 7, 0))')}::BIGINT / 1e1 END AS per_cent,
  CASE WHEN pile IS NOT NULL AND external_id IS NOT NULL THEN greatest(pile, external_id) END AS greatest FROM parts"""
O["readable_ore"] = f"""SELECT part_id, {initcap(READABLE.format(x="(label || '-' || p_brand)"))} AS readable_ore FROM parts"""
O["breakeven"] = f"""SELECT part_id, {half_up(f'{_cents}::HUGEINT*1000000*10506', 'units*10000')}::BIGINT AS break_micro
  FROM parts JOIN part ON p_partkey = part_id"""
O["adjusted_offer"] = f"""SELECT p_partkey AS part_id, ({_cents} + {_low})*100 + ({_cents} - {_low})*35 AS adjusted_offer_x200, {_cents} AS cents FROM part"""
O["cargo_share"] = f"SELECT part_id, {cargo('vol_milli', 'pile::HUGEINT*1000000', 71500, 2)} AS cargo_share FROM parts"
O["ore_value_index"] = f"SELECT DISTINCT ore AS label_ore, (sum({VALUE}) OVER (PARTITION BY good_id))::BIGINT AS value_index FROM ({YIELD})"
O["zone_shift"] = """SELECT o_orderkey, timezone('Asia/Tokyo', timezone('Europe/London', o_orderdate + to_hours((o_orderkey % 24)::INT))) AS host_time FROM orders"""
O["cache_ttl"] = """SELECT o_orderkey, o_orderdate + to_seconds(o_custkey % 60) + to_hours(((o_orderkey + o_custkey % 60) % 5 + 4)::INT) AS cached_until FROM orders"""

# --- reports
O["cheapest_region_for_keyword"] = f"""SELECT {initcap(READABLE.format(x='p.label'))} AS part, 'Ore' AS keyword, {initcap('b.name_region')} AS region,
  b.price*100 // u.price AS of_best_buy_pct, {initcap('u.name_region')} AS of_best_buy_region, b.price AS sellers,
  h.offers_low_range*100 // b.price AS compares_pct, {initcap('h.name_region')} AS compares_region,
  b.price*102/100.0::DOUBLE AS premium_two, b.price*104/100.0::DOUBLE AS premium_four
  FROM parts p JOIN best_local b USING (part_id) JOIN sells s ON s.part_id = p.part_id AND s.region = b.region
  LEFT JOIN best_any u ON u.part_id = p.part_id LEFT JOIN sells h ON h.part_id = p.part_id AND h.name_region LIKE '%AFRICA%'
  WHERE p.part_id IN {tagged('ORE')} AND b.price*s.samples > {PARAMS.notable_supply}"""
O["materials_for_builds"] = material_report(
    BUILD_Q.format(copy=q_copy("l.units", 4), filter=""), "best_local", T13, "quantity", PARAMS.build_list_transport_m3, JOB,
    "NULL::VARCHAR", LISTS)
O["materials_for_builds_short"] = material_report(
    BUILD_Q.format(copy=six(fold(f"l.units::HUGEINT*{M12}")), filter=f"WHERE part_id IN {tagged('COMPONENTS')}"), "best_any", T13, "quantity",
    PARAMS.build_list_transport_m3, JOB, "'Components'", LISTS, "AND quantity - pile*1000000 > 0")
O["materials_three_tier"] = material_report("SELECT * FROM rebuilt", "best_local", T13, "short", PARAMS.deep_transport_m3, "",
                                            "NULL::VARCHAR", LISTS)
O["ore_ranking"] = f"""SELECT DISTINCT {initcap(READABLE.format(x='ore'))} AS ore, {as_double('rep6')} AS repcor, {initcap('mineral')} AS mineral, bid,
  {initcap('name_region')} AS region, value_index FROM (SELECT *, (sum({VALUE}) OVER (PARTITION BY good_id))::BIGINT AS value_index
  FROM ({YIELD} WHERE b.name_region LIKE '%A%'))"""
O["blueprint_pipeline"] = f"""SELECT label, pile, 'Clerk ' || o_custkey % 100 AS installer_name, 'Print ' || o_custkey AS blueprint_type_name,
  o_orderkey % 7 + 1 AS runs, o_orderkey % 3 + 1 AS licensed_runs, ((o_orderkey % 4 + 2)/10.0)::DOUBLE AS probability,
  epoch(timezone('UTC', timezone('Europe/London', o_orderdate)) - TIMESTAMP '1998-06-01 12:30:17')::BIGINT AS ready_in_seconds
  FROM parts LEFT JOIN orders ON o_custkey*3+7 = external_id
  WHERE part_id IN {tagged('BLUEPRINTS')} AND part_id NOT IN {tagged('CONTRACTS')}"""
_practical = """SELECT {part} AS part, min(lowest_offer) AS lowest_offer, min(offers_low_range) AS best_practical,
  ((2*sum(offers_low_range)+count(*))//(2*count(*)))::BIGINT AS avg_low_all_regions{region} FROM parts JOIN sells USING (part_id) {where} GROUP BY label{key}"""
O["practical_price"] = _practical.format(part=initcap("label"), region="", where="", key="")
O["practical_price_per_region"] = _practical.format(part=initcap("label"), region=f", {initcap('name_region')} AS regions",
                                                    where="WHERE label LIKE '%RING%'", key=", name_region")
O["part_price_listing"] = """SELECT label, part_id, direction, samples, lowest_offer, offers_low_range, region, name_region FROM sells JOIN parts USING (part_id)
  WHERE label LIKE '%WIDGET%' AND name_region = 'ASIA'"""
O["what_to_build"] = margin_report("breakeven", "region IN (SELECT region FROM local)", 35, "")
O["what_to_build_promising"] = margin_report(
    "breakeven_any", f"produce_id IN {tagged('MATERIALS')}", -20,
    f"AND bids_high_range*buys > {PARAMS.notable_demand} AND break_micro*100 < highest_bid*120000000 AND lowest_offer*100000000 > break_micro*105")
_short = "CASE WHEN quantity - pile*1000000 > 0 THEN quantity - pile*1000000 END"
_goods = f"({half_up('total', '100000000')}*100)::BIGINT"
_break = "(((total*10506 + 999999999999)//1000000000000)*100)::BIGINT"
O["product_cost_breakdown"] = f"""SELECT '25x ' || {initcap('substr(produce, 1, 22)')} AS produce, {initcap('substr(part, 1, 22)')} AS part, produce_id, part_id,
  {as_double('quantity')} AS quantity, pile, {as_double(_short)} AS short, {cargo('vol_milli', _short, PARAMS.deep_transport_m3, 1)} AS dst,
  {cargo('vol_milli', _short, PARAMS.jump_freighter_m3, 1)} AS jf, price AS quote, {initcap('substr(name_region, 1, 15)')} AS region,
  ({half_up('price*quantity', '100000000')}*100)::BIGINT AS items_tot, CASE WHEN total <> 0 THEN {half_up('price*quantity*100', 'nullif(total, 0)')} END::BIGINT AS pct,
  {_goods} AS goods_tot, {_break} AS break, buy_price*25 AS just_buy_it, {half_up(_goods, '25')} AS goods_unit,
  {half_up(f'{_goods}*93', '2500')} AS dsconut_seven, {half_up(_break, '25')} AS break_unit, buy_price AS just_buy_one
  FROM (SELECT *, {_tot} AS total FROM ({_cost_rows.format(q=q_copy('25', 4), rlike="AND r.label LIKE '%E%'", best='best_local')}))"""

O["bom_cycles"] = O["bom_cycles"].replace("{looped}", CTES["looped"])
_cycles = O.pop("bom_cycles")
ORACLE: dict[str, str] = {name: sql(body) for name, body in O.items()}
_base = sql("SELECT 1 FROM edges, parts").split("\nSELECT 1")[0]
ORACLE["bom_cycles"] = _base + ",\n" + _cycles.replace("WITH RECURSIVE ", "", 1)
ORACLE["region_conflicts"] = O["region_conflicts"]
