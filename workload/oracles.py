"""The same results in DuckDB's SQL, written independently of the library's expressions."""

from __future__ import annotations

from adspindle.operators.funnel import REPORT_COLUMNS
from adspindle.plans.reports import FUNNEL_REPORTS
from adspindle.schema import ODS_COLUMNS, RAW_COLUMNS
from adspindle.sources.dictionary import DEVICE_CODES
from workload.adlog import (
    APP_ENTRIES, COUNTRIES, DAY_OF_THREE, EXTRA, NESTED_RANGES, RANGES, REPLIES, ROW_COLUMN, TODAY, select_list,
)

ORACLES: dict[str, str] = {}


def _cte(**parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{name} AS ({body})" for name, body in parts.items()) + "\n"


ODS = "SELECT " + ", ".join(select_list([*EXTRA, *ODS_COLUMNS])) + " FROM events"
RAW = "SELECT " + ", ".join(select_list([*EXTRA, *RAW_COLUMNS])) + " FROM events"
DEVICES = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in DEVICE_CODES) + ") t(key, value)"

_WITH_ODS = _cte(ods=ODS)


def _over_ods(name: str, body: str) -> None:
    ORACLES[name] = _WITH_ODS + body


def _blank(column: str) -> str:
    return f"coalesce(trim({column}), '') = ''"


def _full(column: str) -> str:
    return f"coalesce(trim({column}), '') <> ''"


# Sources and sinks

ORACLES["scan_json_log"] = _cte(log=RAW) + """
SELECT channelid, client, count(*) AS rows, count(ip) AS ips, min(imei) AS first_imei,
  cast(sum(adorderid) AS bigint) AS orders, round(sum(winprice), 6) AS price
FROM log GROUP BY channelid, client"""
_over_ods("scan_daily_table", f"""
SELECT provincename, cityname, count(*) AS number, '20240115' AS dt FROM ods WHERE dt < '{TODAY}'
GROUP BY provincename, cityname""")
_over_ods("write_daily_keyed", f"""
SELECT provincename, cityname, count(*) AS number,
  CASE WHEN dt < '{TODAY}' THEN '20240115' ELSE '{TODAY}' END AS dt
FROM ods GROUP BY ALL""")
ORACLES["scan_dictionary"] = APP_ENTRIES
_over_ods("check_unique_key", "SELECT ip, count(*) AS rows FROM ods GROUP BY ip HAVING count(*) > 1")
ORACLES["date_keys"] = """
SELECT strftime(ts, '%Y%m%d') AS today, strftime(ts - INTERVAL 1 DAY, '%Y%m%d') AS yesterday,
  count(*) AS rows FROM events GROUP BY ALL"""

# Projections and filters

_over_ods("ods_projection", "SELECT " + ", ".join(
    f"cast({c} AS double) AS {c}" if c in ("longitude", "latitude") else c for c in ODS_COLUMNS
) + " FROM ods")
_LABEL = "CASE client WHEN 1 THEN 'IOS' WHEN 2 THEN 'android' WHEN 3 THEN 'wp' ELSE 'other' END"
_over_ods("derive_client_label", f"SELECT rid, client, {_LABEL} AS label FROM ods")
_IDS = ["imei", "mac", "idfa", "openudid", "androidid"]
_ANY_ID = " OR ".join(_full(c) for c in _IDS)
_over_ods("filter_has_identifier", f"SELECT rid, imei, mac, idfa FROM ods WHERE {_ANY_ID}")
_over_ods("filter_has_location", """
SELECT rid, cast(longitude AS double) AS longitude, cast(latitude AS double) AS latitude FROM ods
WHERE longitude IS NOT NULL AND latitude IS NOT NULL""")
_over_ods("filter_nonempty", "SELECT rid, keywords FROM ods WHERE keywords <> ''")
_over_ods("filter_null_join_key", "SELECT rid, imei FROM ods WHERE imei IS NOT NULL AND imei <> ''")
_over_ods("split_by_key_value", """
SELECT rid, cityname, CASE WHEN cityname IN ('C3', 'C5') THEN 'hot' ELSE 'cold' END AS side FROM ods""")

# Places

_NUMBER = " + ".join(
    f"cast(split_part(ip, '.', {i}) AS bigint) * {w}" for i, w in enumerate((16777216, 65536, 256, 1), 1)
)
_PLACED = f"""
SELECT l.*, CASE WHEN l.ip IS NULL THEN NULL ELSE coalesce(r.country, '未知国家') END AS country,
  CASE WHEN l.ip IS NULL THEN NULL ELSE coalesce(r.area, '未知地区') END AS area, r.longitude, r.latitude
FROM (SELECT *, {_NUMBER} AS number FROM log) l
LEFT JOIN ranges r ON l.number BETWEEN r.ip_start AND r.ip_end"""
_WITH_PLACED = _cte(log=RAW, ranges=RANGES, placed=_PLACED)
ORACLES["ip_range_join"] = _WITH_PLACED + "SELECT rid, ip, country, area, longitude, latitude FROM placed"
ORACLES["ip_range_join_shuffled"] = ORACLES["ip_range_join"]
_FOUND = "CASE WHEN l.ip IS NULL THEN NULL WHEN l.number <= r.ip_end THEN {} ELSE {} END"
ORACLES["ip_range_join_nested"] = _cte(log=RAW, ranges=NESTED_RANGES) + f"""
SELECT l.rid, l.ip, {_FOUND.format('r.country', "'未知国家'")} AS country, {_FOUND.format('r.area', "'未知地区'")} AS area,
  {_FOUND.format('r.longitude', 'NULL')} AS longitude, {_FOUND.format('r.latitude', 'NULL')} AS latitude, way
FROM (SELECT *, {_NUMBER} AS number FROM log) l
ASOF LEFT JOIN ranges r ON l.number >= r.ip_start, (VALUES ('broadcast'), ('shuffled')) ways(way)"""


def _province(c: str) -> str:
    kept = f"rtrim({c}, '省')"
    return f"CASE WHEN {kept} LIKE '%省%' THEN split_part({kept}, '省', 1) || '省' ELSE {c} END"


def _city(c: str) -> str:
    kept = f"rtrim({c}, '省')"
    return f"CASE WHEN {kept} LIKE '%省%' THEN split_part({kept}, '省', 2) ELSE {c} END"


_ENRICHED = {
    "provincename": _province("country"),
    "cityname": _city("country"),
    "longitude": "cast(longitude AS float)",
    "latitude": "cast(latitude AS float)",
}
_SHOWN = {
    **_ENRICHED,
    "longitude": "cast(cast(longitude AS float) AS double)",
    "latitude": "cast(cast(latitude AS float) AS double)",
    ROW_COLUMN: "cast(rid AS string)",
}
ORACLES["ip_geo_enrich"] = _WITH_PLACED + (
    "SELECT " + ", ".join(f"{_SHOWN.get(c, c)} AS {c}" for c in ODS_COLUMNS) + " FROM placed"
)


def _geohash(lon: str, lat: str) -> str:
    """Bit by bit: even bits of the 40 are the longitude's, from the highest down."""
    x = f"greatest(least(cast(floor(cast({lon} AS double) * 1048576 / 360) AS bigint) + 524288, 1048575), 0)"
    y = f"greatest(least(cast(floor(cast({lat} AS double) * 1048576 / 180) AS bigint) + 524288, 1048575), 0)"
    letters = []
    for letter in range(8):
        bits = []
        for place in range(5):
            k = 5 * letter + place
            bits.append(f"((({x if k % 2 == 0 else y}) >> {19 - k // 2}) & 1) * {16 >> place}")
        letters.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', cast({' + '.join(bits)} AS integer) + 1, 1)")
    inside = f"{lon} BETWEEN -180 AND 180 AND {lat} BETWEEN -90 AND 90"
    return f"CASE WHEN {inside} THEN {' || '.join(letters)} END"


_over_ods("fn_geohash", f"""
SELECT rid, {_geohash('lon', 'lat')} AS geohash FROM (
  SELECT rid, (rid * 7919) % 36001 / 100e0 - 180 AS lon, (rid * 104729) % 18301 / 100e0 - 90 AS lat FROM ods)""")

_AREAS = """CASE WHEN json_valid(response) THEN coalesce(array_to_string(
  json_extract_string(response, '$.regeocode.addressComponent.businessAreas[*].name'), ','), '') ELSE '' END"""
ORACLES["fn_parse_districts"] = _cte(replies=REPLIES) + f"SELECT rid, {_AREAS} AS areas FROM replies"
ORACLES["distinct_districts"] = _cte(replies=REPLIES) + f"""
SELECT * FROM (SELECT DISTINCT {_geohash('longitude', 'latitude')} AS geohash, {_AREAS} AS areas FROM replies)
WHERE areas <> '' AND geohash IS NOT NULL"""
_over_ods("distinct_locations", """
SELECT DISTINCT cast(longitude AS double) AS longitude, cast(latitude AS double) AS latitude FROM ods
WHERE longitude IS NOT NULL AND latitude IS NOT NULL""")

_DISTRICT_PARTS = {
    "ods": ODS,
    "replies": REPLIES,
    "districts": f"""
SELECT geohash, string_agg(name, ',' ORDER BY name) AS areas FROM (
  SELECT DISTINCT {_geohash('r.longitude', 'r.latitude')} AS geohash,
    unnest(string_split({_AREAS.replace('response', 'r.response')}, ',')) AS name
  FROM replies r SEMI JOIN ods o ON r.longitude = o.longitude AND r.latitude = o.latitude)
WHERE name <> '' GROUP BY geohash""",
}
ORACLES["build_district_dictionary"] = _cte(**_DISTRICT_PARTS) + "SELECT geohash, areas FROM districts"
ORACLES["build_district_dictionary_increment"] = ORACLES["build_district_dictionary"]
ORACLES["geohash_district_join"] = _cte(**_DISTRICT_PARTS) + f"""
SELECT rid, areas FROM ods LEFT JOIN districts ON {_geohash('longitude', 'latitude')} = geohash"""
ORACLES["geohash_district_join_shuffled"] = ORACLES["geohash_district_join"]

# Joins

_LOOKUP_PARTS = {
    **_DISTRICT_PARTS,
    "apps": APP_ENTRIES,
    "devices": DEVICES,
    "tagged": f"""
SELECT o.*, d.areas, coalesce(a.value, '') AS app_name_found, coalesce(c.value, '') AS client_code,
  coalesce(i.value, '') AS isp_code, coalesce(n.value, '') AS network_code
FROM ods o LEFT JOIN districts d ON {_geohash('o.longitude', 'o.latitude')} = d.geohash
LEFT JOIN apps a ON o.appid = a.key
LEFT JOIN devices c ON cast(coalesce(o.client, 0) AS string) = c.key
LEFT JOIN devices i ON o.ispname = i.key
LEFT JOIN devices n ON o.networkmannername = n.key""",
}
ORACLES["dictionary_lookup_join"] = _cte(**_LOOKUP_PARTS) + """
SELECT rid, app_name_found, client_code, isp_code, network_code FROM tagged"""
ORACLES["dictionary_lookup_join_shuffled"] = ORACLES["dictionary_lookup_join"]


def _lines(key: str) -> str:
    return f"""
SELECT * FROM (SELECT {key} AS key, l_partkey, l_linenumber, l_quantity FROM lineitem) l
LEFT JOIN (SELECT o_orderkey AS key, o_orderstatus, o_totalprice FROM orders) o USING (key)"""


_HOT = "CASE WHEN l_linenumber IN (1, 4) THEN 7 ELSE l_orderkey END"
ORACLES["left_join_plain"] = _lines("l_orderkey")
ORACLES["skew_join_hot_keys"] = _lines(_HOT)
ORACLES["skew_join_full_salt"] = _lines("CASE WHEN l_linenumber = 5 THEN l_orderkey ELSE 1 + l_partkey % 7 END")
ORACLES["broadcast_join"] = """
SELECT l_suppkey, l_orderkey, l_linenumber, s_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey"""
_over_ods("null_safe_left_join", """
SELECT o.rid, o.imei, k.last_rid FROM ods o LEFT JOIN
  (SELECT imei, max(rid) AS last_rid FROM ods WHERE imei <> '' GROUP BY imei) k
ON o.imei = k.imei""")

ORACLES["null_safe_left_join_shuffled"] = """
SELECT l.key, l_partkey, l_linenumber, l_quantity, o_orderstatus, o_totalprice
FROM (SELECT CASE WHEN l_linenumber = 2 THEN NULL ELSE l_orderkey END AS key, l_partkey, l_linenumber, l_quantity FROM lineitem) l
LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 10 = 0 AND o_orderstatus <> 'P') o ON l.key = o.o_orderkey"""
ORACLES["grid_join"] = """
SELECT c.key, c.c_custkey, count(p.p_partkey) AS parts, cast(sum(p.p_size) AS bigint) AS size, max(p.p_partkey) AS last
FROM (SELECT CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_custkey END AS key, c_custkey FROM customer) c
LEFT JOIN (SELECT CASE WHEN p_partkey % 3 = 1 THEN 7 ELSE p_partkey END AS key, p_partkey, p_size FROM part) p ON c.key = p.key
GROUP BY ALL"""

# Reports

_TRADED = "adplatformproviderid >= 100000 AND iseffective = 1 AND isbilling = 1"
_SPENT = f"{_TRADED} AND iswin = 1 AND adorderid > 200000 AND adcreativeid > 200000"
_CONDITIONS = {
    "org_request_num": "requestmode = 1 AND processnode >= 1",
    "valid_request_num": "requestmode = 1 AND processnode >= 2",
    "ad_request_num": "requestmode = 1 AND processnode = 3",
    "bid_num": f"{_TRADED} AND isbid = 1 AND adorderid <> 0",
    "bid_success_num": f"{_TRADED} AND iswin = 1",
    "ad_person_show_num": "requestmode = 2 AND iseffective = 1",
    "ad_person_click_num": "requestmode = 3 AND iseffective = 1",
    "media_show_num": "requestmode = 2 AND iseffective = 1 AND isbilling = 1",
    "media_click_num": "requestmode = 3 AND iseffective = 1 AND isbilling = 1",
}
_MEASURES = ", ".join(
    [f"cast(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS bigint) AS {n}" for n, c in _CONDITIONS.items()]
    + [
        f"round(sum(CASE WHEN {_SPENT} THEN {m} / 1000 ELSE 0 END), 6) AS {n}"
        for n, m in (("dsp_consumtion", "winprice"), ("dsp_cost", "adpayment"))
    ]
)
_RATIOS = """round(cast(bid_success_num AS double) / nullif(bid_num, 0), 6) AS bid_success_rat,
  round(cast(media_click_num AS double) / nullif(media_show_num, 0), 6) AS media_click_rat"""


def _funnel(dims: list[str], shown: str | None = None) -> str:
    group = ", ".join(dims)
    return f"SELECT {shown or group}, * EXCLUDE ({group}), {_RATIOS} FROM (SELECT {group}, {_MEASURES} FROM ods GROUP BY {group})"


for _key, _report in {
    "region": "ad_region_analysis",
    "app": "app_analysis",
    "network": "ad_network_analysis",
    "operator": "ad_operator_analysis",
    "channel": "ad_channel_analysis",
}.items():
    _over_ods(f"report_ad_{_key}", _funnel(FUNNEL_REPORTS[_report]))
_over_ods("report_ad_device", _funnel(["client", "device"], f"{_LABEL} AS client, device"))
_LABELLED = _cte(ods=f"SELECT * REPLACE ({_LABEL} AS client) FROM ({ODS})")
ORACLES["report_ad_device_by_label"] = _LABELLED + _funnel(["client", "device"])
_over_ods("report_province_city", """
SELECT provincename, cityname, count(*) AS number FROM ods GROUP BY provincename, cityname""")
_DIMS = [d for key in FUNNEL_REPORTS.values() for d in key]
ORACLES["report_bundle"] = _LABELLED + " UNION ALL ".join(
    f"SELECT '{report}' AS report, "
    + ", ".join(d if d in key else f"cast(NULL AS {'bigint' if d == 'networkmannerid' else 'string'}) AS {d}" for d in _DIMS)
    + f", number, {', '.join(REPORT_COLUMNS)} FROM (SELECT *, {_RATIOS} FROM (SELECT {', '.join(key)}, count(*) AS number, {_MEASURES} FROM ods GROUP BY {', '.join(key)}))"
    for report, key in FUNNEL_REPORTS.items()
)

ORACLES["report_bundle_by_tuples"] = ORACLES["report_bundle"]

# Other aggregates and set operations

ORACLES["distinct_per_key"] = f"""
SELECT {_HOT} AS key, count(DISTINCT CASE WHEN l_quantity > 3 THEN l_partkey END) AS values FROM lineitem GROUP BY 1"""
ORACLES["quantiles_per_key"] = f"""
SELECT key, quantile, min(l_partkey) AS l_partkey FROM (
  SELECT {_HOT} AS key, l_partkey, row_number() OVER (PARTITION BY {_HOT} ORDER BY l_partkey) AS place, count(*) OVER (PARTITION BY {_HOT}) AS n
  FROM lineitem), (SELECT unnest([0e0, 0.25e0, 0.5e0, 0.9e0, 1e0]) AS quantile)
WHERE place >= ceil(quantile * n) GROUP BY key, quantile"""

ORACLES["salted_two_phase_agg"] = f"SELECT {_HOT} AS key, count(*) AS num FROM lineitem GROUP BY 1"
ORACLES["hot_key_detect"] = f"SELECT {_HOT} AS key, count(*) AS rows FROM lineitem GROUP BY 1 HAVING count(*) >= 100"
_over_ods("union_all", """
SELECT appid, channelid FROM ods UNION ALL SELECT appid, upper(channelid) FROM ods""")
_over_ods("union_distinct", "SELECT DISTINCT cityname, channelid FROM ods")

# Identity

_ID_PARTS = {
    "ods": ODS,
    "id_rows": " UNION ALL ".join(
        f"SELECT rid, dt, {i} AS pos, {c} AS id FROM ods WHERE {_full(c)}" for i, c in enumerate(_IDS)
    ),
    "users": "SELECT rid, any_value(dt) AS dt, arg_min(id, pos) AS userid, string_agg(id, ',' ORDER BY pos) AS ids, "
    "count(*) AS n FROM id_rows GROUP BY rid",
    "edges": "SELECT DISTINCT userid AS u, id AS v FROM users JOIN id_rows USING (rid) WHERE userid <> id",
    "links": "SELECT u AS a, v AS b FROM edges UNION SELECT v, u FROM edges",
    "reach": "SELECT DISTINCT id, id AS other FROM id_rows "
    "UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.other = l.a",
    "members": "SELECT id, min(other) AS component FROM reach GROUP BY id",
}


def _over_ids(name: str, body: str) -> None:
    ORACLES[name] = _cte(**_ID_PARTS) + body


_over_ids("identity_ids", "SELECT rid, userid, ids, cast(n AS integer) AS n FROM users")
_over_ids("identity_edges", "SELECT u, v FROM edges")
_over_ids("connected_components", "SELECT id, component FROM members")
for _name in ("component_attach_join", "component_attach_join_shuffled", "identity_resolve"):
    _over_ids(_name, "SELECT rid, userid, component FROM users JOIN members ON userid = id")
_over_ids("identity_resolve_increment", "SELECT id, component FROM members")
_over_ids("canonical_user_id", "SELECT component, min(id) AS userid FROM members GROUP BY component")

# Tags


def _pieces(column: str) -> str:
    kept = f"rtrim({column}, ',')"
    return (
        f"unnest(CASE WHEN {column} IS NULL OR ({column} <> '' AND {kept} = '') "
        f"THEN [] ELSE string_split({kept}, ',') END)"
    )


_TAG_RULES = {
    "tag_app": [f"'APP_' || CASE WHEN {_blank('appname')} THEN app_name_found ELSE appname END"],
    "tag_device": [
        "'DC_' || coalesce(device, 'null')",
        "'DT_' || client_code",
        "'ISP_' || isp_code",
        "'NT_' || network_code",
        "'DET_' || cast(coalesce(devicetype, 0) AS string)",
    ],
    "tag_region": ["'RN_' || coalesce(provincename, 'null')", "'CT_' || coalesce(cityname, 'null')"],
    "tag_keyword": [f"'KW_' || {_pieces('keywords')}"],
    "tag_channel": ["'CN_' || coalesce(channelid, 'null')"],
    "tag_age": ["'AGE_' || coalesce(age, 'null')"],
    "tag_sex": ["'SEX_' || coalesce(sex, 'null')"],
    "tag_business_area": [f"'BA_' || {_pieces('areas')}"],
}


def _tags(rules: list[str]) -> str:
    return " UNION ".join(f"SELECT rid, {rule} AS tag FROM tagged" for rule in rules)


for _name, _rules in _TAG_RULES.items():
    ORACLES[_name] = _cte(**_LOOKUP_PARTS) + f"SELECT rid, tag, cast(1 AS double) AS weight FROM ({_tags(_rules)})"
_EVERY_RULE = [r for rules in _TAG_RULES.values() for r in rules]
ORACLES["tag_all"] = _cte(**_LOOKUP_PARTS) + f"SELECT rid, tag, cast(1 AS double) AS weight FROM ({_tags(_EVERY_RULE)})"

_SOME_RULES = [r for n in ("tag_channel", "tag_keyword", "tag_age", "tag_sex") for r in _TAG_RULES[n]]
_TAG_TEXT = "string_agg(tag || ' -> ' || cast(round(weight, 6) AS string), ',' ORDER BY tag)"


def _merged(weight: str, where: str = "true") -> str:
    return f"""
SELECT component AS userid, tag, sum({weight}) AS weight
FROM row_tags JOIN users USING (rid) JOIN members ON users.userid = members.id WHERE {where}
GROUP BY component, tag"""


_TEXT_FORM = f"""
SELECT t.userid, m.ids AS {{ids}}, t.tags FROM
  (SELECT userid, {_TAG_TEXT} AS tags FROM merged GROUP BY userid) t JOIN
  (SELECT component AS userid, string_agg(id, ',' ORDER BY id) AS ids FROM members GROUP BY component) m
  USING (userid)"""
ORACLES["merge_user_tags"] = _cte(
    **_ID_PARTS, tagged="SELECT * FROM ods", row_tags=_tags(_SOME_RULES), merged=_merged("1e0")
) + _TEXT_FORM.format(ids="ids")
_PROFILE_PARTS = {**_LOOKUP_PARTS, **_ID_PARTS, "row_tags": _tags(_EVERY_RULE)}
ORACLES["user_profile_today"] = _cte(**_PROFILE_PARTS, merged=_merged("1e0")) + """
SELECT userid, tag, round(weight, 6) AS weight FROM merged"""
ORACLES["user_profile_with_history"] = _cte(
    **_PROFILE_PARTS, merged=_merged(f"CASE WHEN users.dt < '{TODAY}' THEN 0.9e0 ELSE 1e0 END")
) + _TEXT_FORM.format(ids='"allUserId"')
ORACLES["user_profile_with_history_shuffled"] = ORACLES["user_profile_with_history"]

_over_ods("profile_round_trip", """
SELECT userid, tag, round(count(*) * 0.9e0 * 0.9e0, 6) AS weight, cast(1 AS bigint) AS ids FROM (
  SELECT CASE WHEN rid % 2 = 0 THEN 'a,1' ELSE 'u -> ' || cast(rid % 10 AS string) END AS userid,
    CASE WHEN rid % 2 = 0 THEN 'KW_x, y -> ' || cast(rid AS string)
      ELSE concat_ws(' -> ', 'KW_a', channelid, keywords) END AS tag FROM ods)
GROUP BY userid, tag""")

# Two days of the daily job: places from the addresses, and each day's own district dictionary.
_DAY = f"dt < '{TODAY}'"
_DAY_PARTS = {
    "log": RAW,
    "ranges": RANGES,
    "placed": _PLACED,
    "ods": "SELECT rid, dt, " + ", ".join(f"{_ENRICHED.get(c, c)} AS {c}" for c in ODS_COLUMNS) + " FROM placed",
    "replies": REPLIES,
    "districts": f"""
SELECT first_day, geohash, string_agg(name, ',' ORDER BY name) AS areas FROM (
  SELECT DISTINCT o.first_day, {_geohash('r.longitude', 'r.latitude')} AS geohash,
    unnest(string_split({_AREAS.replace('response', 'r.response')}, ',')) AS name
  FROM replies r JOIN (SELECT DISTINCT {_DAY} AS first_day, longitude, latitude FROM ods) o
    ON r.longitude = o.longitude AND r.latitude = o.latitude)
WHERE name <> '' GROUP BY first_day, geohash""",
    "apps": APP_ENTRIES,
    "devices": DEVICES,
    "tagged": _LOOKUP_PARTS["tagged"].replace("= d.geohash", f"= d.geohash AND d.first_day = ({_DAY})"),
}
ORACLES["run_day_twice"] = _cte(
    **_DAY_PARTS,
    **{k: v for k, v in _ID_PARTS.items() if k != "ods"},
    row_tags=_tags(_EVERY_RULE),
    merged=_merged(f"CASE WHEN users.{_DAY} THEN 0.9e0 ELSE 1e0 END"),
) + "SELECT userid, tag, round(weight, 6) AS weight FROM merged"

# Three days, of which each has its own dictionary too.
_THREE_PARTS = _DAY_PARTS | {
    "districts": _DAY_PARTS["districts"].replace(f"DISTINCT {_DAY} AS first_day", f"DISTINCT {DAY_OF_THREE} AS first_day"),
    "tagged": _LOOKUP_PARTS["tagged"].replace("= d.geohash", f"= d.geohash AND d.first_day = {DAY_OF_THREE}"),
}
ORACLES["run_three_days"] = _cte(
    **_THREE_PARTS,
    **{k: v for k, v in _ID_PARTS.items() if k != "ods"},
    row_tags=_tags(_EVERY_RULE),
    merged=_merged(f"CASE {DAY_OF_THREE} WHEN 0 THEN 0.9e0 * 0.9e0 WHEN 1 THEN 0.9e0 ELSE 1e0 END"),
) + """
SELECT userid, tag, round(weight, 6) AS weight, ids
FROM merged JOIN (SELECT component AS userid, count(*) AS ids FROM members GROUP BY component) USING (userid)"""

# History

_PARSED_PARTS = {
    "ods": ODS,
    "entries": """
SELECT rid, 'CN_' || channelid AS tag, CASE WHEN rid % 3 = 0 THEN 2.25e0 ELSE 1.5e0 END AS weight FROM ods
UNION ALL SELECT rid, 'A', cast(rid % 5 AS double) FROM ods""",
}
# Pieces without a weight: 'broken -> x', and the two empty pieces of a lone comma unless they end the text.
ORACLES["parse_tag_string"] = _cte(**_PARSED_PARTS) + """
SELECT rid, cast(CASE WHEN rid % 4 = 0 THEN 1 ELSE 0 END AS integer) AS bad, tag, weight FROM entries"""
ORACLES["format_tag_string"] = _cte(**_ID_PARTS, entries=_PARSED_PARTS["entries"]) + """
SELECT o.rid, coalesce(u.ids, '') AS "allUserId", e.tags FROM ods o LEFT JOIN users u ON o.rid = u.rid JOIN
  (SELECT rid, string_agg(tag || ' -> ' || cast(weight AS string), ',' ORDER BY tag) AS tags FROM entries GROUP BY rid) e
  ON o.rid = e.rid"""
ORACLES["decay_tags"] = _cte(**_PARSED_PARTS) + "SELECT rid, tag, round(weight * 0.9e0, 6) AS weight FROM entries"

# Scalar functions

_over_ods("fn_ip_to_long", f"""
SELECT rid, CASE WHEN rid % 50 IN (1, 2) THEN NULL ELSE {_NUMBER} END AS number FROM ods""")
_over_ods("fn_long_to_ip", """
SELECT rid, cast(n // 16777216 AS string) || '.' || cast(n // 65536 % 256 AS string) || '.' ||
  cast(n // 256 % 256 AS string) || '.' || cast(n % 256 AS string) AS ip
FROM (SELECT rid, (rid * 429496) % 4294967296 AS n FROM ods)""")
ORACLES["fn_province"] = _cte(countries=COUNTRIES) + f"SELECT rid, {_province('country')} AS province FROM countries"
ORACLES["fn_city"] = _cte(countries=COUNTRIES) + f"SELECT rid, {_city('country')} AS city FROM countries"
_over_ods("fn_area_clean", "SELECT rid, CASE WHEN rid % 4 = 0 THEN '本机或本网络' ELSE cityname END AS area FROM ods")
_over_ods("fn_private_ip", "SELECT rid, CASE WHEN rid % 4 = 0 THEN NULL ELSE ip END AS ip FROM ods")
_over_ods("fn_salt", "SELECT rid, channelid, true AS in_range, channelid AS unsalted FROM ods")
_over_ods("fn_unsalt", "SELECT rid, keywords AS key FROM ods")
_over_ods("fn_prefix", "SELECT rid, cast(rid % 10 AS string) || '#' || channelid AS key FROM ods")
_over_ods("fn_blank", "SELECT rid, " + ", ".join(f"{_full(c)} AS {c}" for c in ("imei", "mac", "idfa", "appname")) + " FROM ods")
_over_ods("fn_safe_ratio", """
SELECT rid, round(cast(adcreativeid AS double) / nullif(requestmode - 2, 0), 6) AS ratio FROM ods""")

# Skew tools and SQL names

ORACLES["partition_profile"] = "SELECT count(*) AS all_rows, true AS sound FROM lineitem"
ORACLES["replicate_rows"] = """
SELECT c_custkey, cast(i AS string) || '#' || c_mktsegment AS key FROM customer, range(10) r(i)"""
_over_ods("sql_functions", f"""
SELECT rid, {_geohash('longitude', 'latitude')} AS geohash, '3#' || channelid AS prefixed, channelid AS unsalted
FROM ods""")
