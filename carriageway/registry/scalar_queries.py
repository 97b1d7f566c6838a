"""Scalar functions F1 to F45, each over one whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from carriageway.functions import rules, text, times
from carriageway.plans.reports import day_name
from carriageway.registry.check_sql import DAYS_SINCE, SEVERITY_CASE, bands, rnd, using
from carriageway.registry.core import add


def scalar(name: str, source: str, key: str, spark: dict, sql: dict) -> None:
    """Register ``key`` plus the given expressions over a test table or domain view."""
    fixture = source.startswith("fx_")
    keys = key.split()

    def run(i):
        base = i.fx(source[3:]) if fixture else i.table(source)
        return base.select(*keys, *[(e() if callable(e) else e).alias(n) for n, e in spark.items()])

    body = f"SELECT {', '.join(keys)}, " + ", ".join(f"{e} AS {n}" for n, e in sql.items()) + f" FROM {source}"
    add(name, run, using(source, body) if fixture else body)


C = F.col
scalar("f01_trim", "fx_incidents", "incident_id", {"v": lambda: text.trimmed("incident_type")}, {"v": "trim(incident_type)"})
scalar("f02_upper_trim", "fx_incidents", "incident_id", {"v": lambda: text.trimmed_upper("incident_type")},
       {"v": "upper(trim(incident_type))"})
scalar("f03_upper", "fx_incidents", "incident_id", {"v": lambda: F.upper("incident_type")}, {"v": "upper(incident_type)"})
scalar("f04_concat_mixed", "fx_incidents", "incident_id",
       {"v": lambda: F.concat(F.year("incident_datetime").cast("string"), F.lit("-"), C("latitude").cast("string"))},
       {"v": "concat(year(incident_datetime), '-', latitude)"})
scalar("f05_left_pad", "fx_incidents", "incident_id",
       {"v": lambda: F.lpad(F.month("incident_datetime").cast("string"), 2, "0")},
       {"v": "lpad(cast(month(incident_datetime) AS varchar), 2, '0')"})
scalar("f06_date_parts", "fx_incidents", "incident_id", {
    "y": lambda: F.year("incident_datetime"), "m": lambda: F.month("incident_datetime"),
    "h": lambda: F.hour("incident_datetime")}, {
    "y": "cast(year(incident_datetime) AS int)", "m": "cast(month(incident_datetime) AS int)",
    "h": "cast(hour(incident_datetime) AS int)"})
scalar("f07_day_of_week", "fx_incidents", "incident_id", {"v": lambda: F.dayofweek("incident_datetime")},
       {"v": "cast(dayofweek(incident_datetime) + 1 AS int)"})
scalar("f08_weekend", "fx_incidents", "incident_id", {"v": lambda: times.is_weekend("incident_datetime")},
       {"v": "dayofweek(incident_datetime) IN (0, 6)"})
scalar("f09_day_name", "fx_incidents", "incident_id", {"v": lambda: day_name(F.dayofweek("incident_datetime"))},
       {"v": "dayname(incident_datetime)"})
scalar("f10_date_format", "fx_incidents", "incident_id", {"v": lambda: F.date_format("incident_datetime", "yyyy-MM-dd")},
       {"v": "strftime(incident_datetime, '%Y-%m-%d')"})
scalar("f11_to_date", "fx_incidents", "incident_id", {"v": lambda: F.to_date("incident_datetime")},
       {"v": "cast(incident_datetime AS date)"})
scalar("f12_days_since", "fx_bridges", "bridge_id", {"v": lambda: times.days_since("last_inspection_date")}, {"v": DAYS_SINCE})
scalar("f14_round", "fx_bridges", "bridge_id", {
    "one": lambda: rules.rounded(C("sufficiency_rating") * 0.37, 1), "four": lambda: rules.rounded(C("latitude") / 7, 4)}, {
    "one": rnd("sufficiency_rating * 0.37e0", 1), "four": rnd("latitude / 7", 4)})
scalar("f15_greatest", "fx_bridges", "bridge_id",
       {"v": lambda: F.greatest(*[F.when(F.startswith(C(c), F.lit("P")), 1).otherwise(0) for c in
                                  ("deck_condition", "superstructure_condition", "substructure_condition")])},
       {"v": "greatest(" + ", ".join(f"CASE WHEN {c} LIKE 'P%' THEN 1 ELSE 0 END" for c in
                                     ("deck_condition", "superstructure_condition", "substructure_condition")) + ")"})
scalar("f16_least", "fx_bridges", "bridge_id",
       {"v": lambda: rules.rounded(F.least("span_length_ft", "deck_width_ft", C("sufficiency_rating") * 2), 4)},
       {"v": rnd("least(span_length_ft, deck_width_ft, sufficiency_rating * 2)", 4)})
scalar("f17_cast", "fx_bridges", "bridge_id", {
    "d": lambda: C("avg_daily_traffic").cast("double"), "i": lambda: F.floor("span_length_ft").cast("int"),
    "s": lambda: C("year_built").cast("string"), "t": lambda: C("last_inspection_date").cast("date")}, {
    "d": "cast(avg_daily_traffic AS double)", "i": "cast(floor(span_length_ft) AS int)",
    "s": "cast(year_built AS varchar)", "t": "cast(last_inspection_date AS date)"})
IRI_BANDS = [(60, "Very Good"), (95, "Good"), (170, "Fair"), (220, "Mediocre")]
scalar("f18_banded_case", "fx_pavement", "segment_id iri", {"v": lambda: rules.banded("iri", "<=", IRI_BANDS, "Poor")},
       {"v": bands("iri", "<=", IRI_BANDS, "Poor")})
scalar("f19_simple_case", "fx_incidents", "incident_id severity",
       {"v": lambda: rules.looked_up("severity", {"Fatal": 5, "Serious Injury": 4, "Minor Injury": 3, "Property Damage Only": 2}, 1)},
       {"v": SEVERITY_CASE})
scalar("f20_boolean_column", "fx_incidents", "incident_id",
       {"v": lambda: C("fatalities") > 0, "w": lambda: C("injuries") > 5}, {"v": "fatalities > 0", "w": "injuries > 5"})
scalar("f21_null_if", "fx_incidents", "incident_id", {"v": lambda: F.nullif("fatalities", F.lit(0))},
       {"v": "nullif(fatalities, 0)"})
scalar("f22_coalesce_zero", "fx_incidents", "incident_id", {"v": lambda: F.coalesce("injuries", F.lit(0))},
       {"v": "coalesce(injuries, 0)"})
scalar("f23_safe_divide", "fx_incidents", "incident_id", {"v": lambda: rules.rounded(rules.ratio("injuries", "fatalities"), 6)},
       {"v": rnd("injuries * 1.0e0 / nullif(fatalities, 0)", 6)})
scalar("f24_guarded_divide", "fx_incidents", "incident_id", {
    "zero": lambda: rules.rounded(rules.guarded_ratio("injuries", "fatalities", F.lit(0.0)), 6),
    "nothing": lambda: rules.rounded(rules.guarded_ratio("injuries", "fatalities", F.lit(None)), 6)}, {
    "zero": rnd("CASE WHEN fatalities > 0 THEN injuries / fatalities ELSE 0e0 END", 6),
    "nothing": rnd("CASE WHEN fatalities > 0 THEN injuries / fatalities END", 6)})
scalar("f25_change_percent", "fx_incidents", "incident_id", {"v": lambda: rules.change_pct("injuries", "fatalities")},
       {"v": rnd("(cast(injuries - fatalities AS double) / nullif(fatalities, 0)) * 100", 1)})
scalar("f26_trend_arrow", "fx_incidents", "incident_id", {"v": lambda: rules.trend_arrow("fatalities", "injuries")},
       {"v": "CASE WHEN fatalities > injuries THEN '▲' ELSE '▼' END"})
scalar("f27_format_number", "fx_bridges", "bridge_id", {
    "whole": lambda: F.format_number(C("avg_daily_traffic") * 1000, 0),
    "tenth": lambda: F.format_number(C("span_length_ft") * 100, 1)}, {
    "whole": "format('{:,}', avg_daily_traffic * 1000)", "tenth": "format('{:,.1f}', span_length_ft * 100)"})
scalar("f28_text_to_boolean", "fx_bridges", "bridge_id", {
    "a": lambda: text.means_true("functionally_obsolete"), "b": lambda: text.means_true("structurally_deficient")}, {
    "a": "lower(trim(functionally_obsolete)) IN ('true', 't', '1', 'yes', 'y')",
    "b": "lower(trim(structurally_deficient)) IN ('true', 't', '1', 'yes', 'y')"})
scalar("f29_prefix_test", "fx_bridges", "bridge_id", {"v": lambda: text.starts_with("deck_condition", "P")},
       {"v": "deck_condition LIKE 'P%'"})
scalar("f30_equals_true_text", "fx_bridges", "bridge_id", {
    "a": lambda: C("functionally_obsolete") == "true", "b": lambda: C("structurally_deficient") == "true"}, {
    "a": "functionally_obsolete = 'true'", "b": "structurally_deficient = 'true'"})
scalar("f31_angle_functions", "fx_incidents", "incident_id", {
    "a": lambda: rules.rounded(F.sin(F.radians("latitude")), 6), "b": lambda: rules.rounded(F.cos(F.radians("longitude")), 6),
    "c": lambda: rules.rounded(F.degrees(F.atan2("longitude", "latitude")), 6),
    "d": lambda: rules.rounded(F.asin(C("latitude") / 100), 6), "e": lambda: rules.rounded(F.sqrt(F.pow("latitude", F.lit(3))), 6)}, {
    "a": rnd("sin(radians(latitude))", 6), "b": rnd("cos(radians(longitude))", 6),
    "c": rnd("degrees(atan2(longitude, latitude))", 6), "d": rnd("asin(latitude / 100)", 6), "e": rnd("sqrt(pow(latitude, 3))", 6)})
scalar("f32_modulo_wrap", "fx_incidents", "incident_id", {
    "a": lambda: rules.rounded(F.pmod(C("longitude") * 7, F.lit(360.0)), 4), "b": lambda: F.floor("longitude")}, {
    "a": rnd("CASE WHEN (longitude * 7) % 360 < 0 THEN (longitude * 7) % 360 + 360 ELSE (longitude * 7) % 360 END", 4),
    "b": "cast(floor(longitude) AS bigint)"})
scalar("f33_substring_iso", "events", "event_id", {
    "minute": lambda: F.substring(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), 1, 16),
    "day": lambda: F.substring(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), 1, 10)}, {
    "minute": "substring(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 16)", "day": "substring(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 10)"})
HREF = r'href="([^"]+)"'
scalar("f34_regex_extract", "pages", "page_id", {
    "link": lambda: text.captured("html", HREF), "title": lambda: text.captured("html", r"<title>([^<]+)"),
    "lang": lambda: text.captured("html", r'<html lang="([a-z]+)"'), "picture": lambda: text.captured("html", r'src="([^"]+)"')}, {
    n: f"CASE WHEN regexp_matches(html, '{p}') THEN regexp_extract(html, '{p}', 1) END" for n, p in {
        "link": HREF, "title": "<title>([^<]+)", "lang": '<html lang="([a-z]+)"', "picture": 'src="([^"]+)"'}.items()})
scalar("f35_regex_strip", "pages", "page_id url", {
    "no_query": lambda: text.stripped("url", r"\s*\?.*"), "no_scheme": lambda: text.stripped("url", r"^(http|https)://")}, {
    "no_query": r"trim(regexp_replace(url, '\s*\?.*', '', 'g'))", "no_scheme": "trim(regexp_replace(url, '^(http|https)://', '', 'g'))"})
scalar("f36_regex_number_rewrite", "part", "p_partkey", {
    "v": lambda: text.with_number(F.concat(F.lit("Now 12 cameras, "), C("p_size").cast("string"), F.lit(" active incidents")),
                                  "active incidents", C("p_partkey"))}, {
    "v": r"regexp_replace(concat('Now 12 cameras, ', p_size, ' active incidents'), '\d+ active incidents', concat(p_partkey, ' active incidents'))"})
scalar("f37_title_words", "orders", "o_orderkey", {
    "v": lambda: text.title_words(F.lower(F.concat(C("o_orderpriority"), F.lit("-zone"))))}, {
    "v": "array_to_string([concat(upper(substring(w, 1, 1)), lower(substring(w, 2))) for w in "
         "string_split(replace(lower(concat(o_orderpriority, '-zone')), '-', ' '), ' ')], ' ')"})
scalar("f38_mail_slug", "fx_employees", "employee_id", {"v": lambda: text.mail_slug("name", "dot.example")}, {
    "v": "concat(replace(replace(replace(replace(lower(name), ' ', '.'), '#', '.'), '''', ''), ',', ''), '@dot.example')"})
scalar("f39_text_default", "fx_incidents", "incident_id", {
    "v": lambda: text.text_or(F.when(C("status") == "Closed", "  ").when(C("status") == "Reported", C("incident_type")), "Unknown")}, {
    "v": "coalesce(nullif(trim(CASE WHEN status = 'Closed' THEN '  ' WHEN status = 'Reported' THEN incident_type END), ''), 'Unknown')"})
scalar("f40_contains", "documents", "doc_id", {
    "a": lambda: F.contains("text", F.lit("the")), "b": lambda: F.contains("text", F.lit("LICENSE"))}, {
    "a": "contains(text, 'the')", "b": "contains(text, 'LICENSE')"})
scalar("f41_json_fields", "events", "event_id", {
    "parsed": lambda: F.from_json("props", "k bigint")["k"], "field": lambda: F.get_json_object("props", "$.k"),
    "written": lambda: F.to_json(F.struct(C("user_id"), C("event_type")))}, {
    "parsed": "cast(json_extract_string(props, '$.k') AS bigint)", "field": "json_extract_string(props, '$.k')",
    "written": "cast(to_json({'user_id': user_id, 'event_type': event_type}) AS varchar)"})
scalar("f42_date_arithmetic", "fx_employees", "employee_id", {
    "later": lambda: F.date_add("birth_date", 30),
    "years": lambda: rules.rounded(times.years_between(F.lit(times.AS_OF), C("birth_date")), 4)}, {
    "later": "birth_date + 30", "years": rnd("date_diff('day', birth_date, DATE '2024-12-31') / 365.25e0", 4)})
scalar("f43_text_to_number", "pages", "page_id", {
    "v": lambda: text.numeric(F.regexp_extract("url", r"/(\d+)", 1)),
    "none": lambda: text.numeric(F.substring("url", 1, 4))}, {
    "v": r"try_cast(regexp_extract(url, '/(\d+)', 1) AS double)", "none": "try_cast(substring(url, 1, 4) AS double)"})
scalar("f44_clamp", "events", "event_id", {"v": lambda: rules.rounded(rules.clamped(C("value"), 5.0, 40.0), 6)},
       {"v": rnd("least(greatest(value, 5.0e0), 40.0e0)", 6)})
scalar("f45_base64_and_length", "documents", "doc_id", {
    "n_bytes": lambda: F.octet_length(C("text").cast("binary")).cast("bigint"),
    "encoded": lambda: F.regexp_replace(F.base64(C("text").cast("binary")), r"\s", "")}, {
    "n_bytes": "cast(octet_length(encode(text)) AS bigint)", "encoded": "to_base64(encode(text))"})

# The load stamp is the one clock read; everything else takes the reference date.
scalar("f13_reference_date", "fx_incidents", "incident_id", {
    "as_of": lambda: F.lit(times.AS_OF), "future": lambda: C("incident_datetime") > times.at_midnight(times.AS_OF)}, {
    "as_of": "DATE '2024-12-31'", "future": "incident_datetime > TIMESTAMP '2024-12-31 00:00:00'"})
scalar("u03_expression_macros", "fx_bridges", "bridge_id", {
    "a": lambda: text.trimmed_upper("route_id"), "b": lambda: F.year("last_inspection_date"),
    "c": lambda: F.dayofweek("last_inspection_date"), "d": lambda: times.days_since("last_inspection_date"),
    "e": lambda: rules.rounded(rules.ratio("avg_daily_traffic", C("year_built") % 3), 4),
    "f": lambda: text.means_true("structurally_deficient"), "g": lambda: text.starts_with("deck_condition", "F")}, {
    "a": "upper(trim(route_id))", "b": "cast(year(last_inspection_date) AS int)",
    "c": "cast(dayofweek(last_inspection_date) + 1 AS int)", "d": DAYS_SINCE,
    "e": rnd("avg_daily_traffic * 1.0e0 / nullif(year_built % 3, 0)", 4),
    "f": "lower(trim(structurally_deficient)) IN ('true', 't', '1', 'yes', 'y')", "g": "deck_condition LIKE 'F%'"})
