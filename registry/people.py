"""Privacy jobs, lead forms and wording, over customers and the users of error events."""

from __future__ import annotations

from pyspark.sql import functions as F

from campaign_analytics.functions import text
from campaign_analytics.operators.joins import suppress
from campaign_analytics.plans import leads as lead_plan
from campaign_analytics.plans import privacy

from .tables import URLS, by_index, read, sql_index, with_tables

SALT = "s1"
MAILS = ["@example.com", "@example", " @example.com", "@a.b.c", ""]
BLANKS = ["Ann", "  ", None, "Özge ", "", "Bo"]
INDUSTRIES = ["Retail - Food", "Bitte auswählen", "Hotels", " Bitte auswählen "]

SQL = {
    "people": f"""
    SELECT 'u' || c_custkey AS external_id, lower(c_name) || '@example.com' AS email, '030' || c_custkey AS phone,
           {sql_index(BLANKS, "c_custkey % 6")} AS first_name, c_name AS last_name, '1990-01-01' AS dob FROM customer""",
    "leaving": "SELECT DISTINCT 'u' || user_id AS id FROM events WHERE event_type = 'error'",
    "lead_rows": f"""
    SELECT c_custkey AS lead_id, {sql_index(BLANKS, "(c_custkey + 1) % 6")} AS first_name, c_name AS last_name,
           'c' || c_custkey || {sql_index(MAILS, "c_custkey % 5")} AS email, '0170' AS phone, c_mktsegment AS company,
           CAST(c_custkey * 7919 AS VARCHAR) AS zip, {sql_index(INDUSTRIES, "c_custkey % 4")} AS industry,
           'Ja' AS callback, 'zwei' AS bedarf__c, {sql_index(URLS, "c_custkey % 13")} AS page_url,
           TIMESTAMP '2024-01-01' + to_milliseconds(c_custkey * 1001) AS ts FROM customer""",
}


def _people(spark, d):
    return read(spark, d, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("external_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("030"), F.col("c_custkey").cast("string")).alias("phone"),
        by_index(BLANKS, "c_custkey % 6").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.lit("1990-01-01").alias("dob"),
    )


def _leaving(spark, d):
    return (
        read(spark, d, "events")
        .where("event_type = 'error'")
        .select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("id"))
        .distinct()
    )


def _anonymized(part):
    def run(spark, d):
        return getattr(privacy.anonymize_users(_people(spark, d), _leaving(spark, d), SALT), part)

    return run


def delete_payloads(shards):
    return lambda spark, d: privacy.delete_payloads(_leaving(spark, d), shards=shards)


def suppressed(spark, d):
    return suppress(_people(spark, d), _leaving(spark, d), "external_id")


def _leads(spark, d):
    key = F.col("c_custkey")
    return read(spark, d, "customer").select(
        key.alias("lead_id"),
        by_index(BLANKS, "(c_custkey + 1) % 6").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("c"), key.cast("string"), by_index(MAILS, "c_custkey % 5")).alias("email"),
        F.lit("0170").alias("phone"),
        F.col("c_mktsegment").alias("company"),
        (key * 7919).cast("string").alias("zip"),
        by_index(INDUSTRIES, "c_custkey % 4").alias("industry"),
        F.lit("Ja").alias("callback"),
        F.lit("zwei").alias("bedarf__c"),
        by_index(URLS, "c_custkey % 13").alias("page_url"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, c_custkey * 1.001)").alias("ts"),
    )


def validate_leads(profile):
    def run(spark, d):
        return lead_plan.validate_leads(_leads(spark, d), profile).select(
            "lead_id",
            F.array_join("empty_fields", "|").alias("empty_fields"),
            F.array_join("errors", "|").alias("errors"),
            "first_error",
            F.col("accepted").cast("int").alias("accepted"),
        )

    return run


def lead_records(spark, d):
    out = lead_plan.lead_records(_leads(spark, d), "lead-form")
    return out.select("lead_id", *lead_plan.URL_FIELDS, "utm_adgroup", "datetime")


def greeting(spark, d):
    name = by_index(BLANKS, "c_custkey % 6")
    language = by_index(["de", "en", None], "c_custkey % 3")
    return read(spark, d, "customer").select(
        "c_custkey",
        text.greeting(name).alias("greeting"),
        text.localized(language, F.lit("Hallo"), F.lit("Hello")).alias("hello"),
        text.truthy(by_index(["true", "false", None, "TRUE"], "c_custkey % 4")).cast("int").alias("flag"),
    )


QUERIES = {
    "anonymize_users": _anonymized("users"),
    "rename_map": _anonymized("rename_map"),
    "anonymize_payloads": _anonymized("update_payloads"),
    "rename_payloads": _anonymized("rename_payloads"),
    "delete_payloads": delete_payloads(8),
    "delete_payloads_exact": delete_payloads(None),
    "suppress": suppressed,
    "validate_leads": validate_leads("full"),
    "validate_leads_short": validate_leads("short"),
    "lead_records": lead_records,
    "greeting": greeting,
}


def _exact_payload_sql(root, record):
    return with_tables(
        f"""
    SELECT 0 AS shard, seat // 50 AS batch_no, count(*) AS records,
           CAST(to_json({{'{root}': list({record} ORDER BY seat)}}) AS VARCHAR) AS payload
    FROM (SELECT id, row_number() OVER (ORDER BY CAST('0x' || substr(sha256(id), 1, 8) AS BIGINT) % 65536, id) - 1 AS seat
          FROM leaving) GROUP BY ALL""",
        SQL,
    )


def _payload_sql(root, record, shards, key="id"):
    return with_tables(
        f"""
    SELECT shard, seat // 50 AS batch_no, count(*) AS records,
           CAST(to_json({{'{root}': list({record} ORDER BY seat)}}) AS VARCHAR) AS payload
    FROM (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY {key}) - 1 AS seat
          FROM (SELECT *, CAST(CAST('0x' || substr(sha256({key}), 1, 8) AS BIGINT) % {shards} AS INTEGER) AS shard
                FROM leaving))
    GROUP BY ALL""",
        SQL,
    )


_NEW_ID = f"sha256(id || '{SALT}')"
_BODY = """{'external_id': id, 'email': 'anonymized@user.com', 'phone': '1234567890', 'first_name': 'anonymized',
    'last_name': 'anonymized', 'dob': '1970-01-01'}"""


def _clean(col, value):
    return f"CASE WHEN id IS NULL THEN {col} ELSE '{value}' END AS {col}"


def _leads_sql(body):
    return with_tables(body, SQL)


_TRIMMED = r"regexp_replace(coalesce({0}, ''), '^\s+|\s+$', '', 'g')"
_EMPTY = ", ".join(
    f"CASE WHEN {_TRIMMED.format(name)} = ''"
    + (f" OR {_TRIMMED.format(name)} = 'Bitte auswählen'" if name in ("industry", "callback") else "")
    + f" THEN '{name}' END"
    for name in lead_plan.REQUIRED
)
_BAD_MAIL = r"NOT regexp_matches({0}, '^[^\s@]+@[^\s@]+\.[^\s@]+$')".format(_TRIMMED.format("email"))
_MAIL_TEXT = "'Bitte hinterlegen Sie eine gültige Email-Adresse.'"


def _form(name):
    found = f"regexp_extract(regexp_replace(page_url, '#.*$', ''), '[?&]{name}=([^&#]*)', 1)"
    return f"url_decode(replace({found}, '+', ' ')) AS {name}"


ORACLE = {
    "anonymize_users": with_tables(
        f"""SELECT CASE WHEN id IS NULL THEN external_id ELSE {_NEW_ID} END AS external_id,
        {_clean("email", "anonymized@user.com")}, {_clean("phone", "1234567890")}, {_clean("first_name", "anonymized")},
        {_clean("last_name", "anonymized")}, {_clean("dob", "1970-01-01")}
        FROM people LEFT JOIN leaving ON id = external_id""",
        SQL,
    ),
    "rename_map": with_tables(
        f"SELECT id AS current_external_id, {_NEW_ID} AS new_external_id FROM leaving", SQL
    ),
    "anonymize_payloads": _exact_payload_sql("attributes", _BODY),
    "rename_payloads": _exact_payload_sql(
        "external_id_renames", f"{{'current_external_id': id, 'new_external_id': {_NEW_ID}}}"
    ),
    "delete_payloads": _payload_sql("external_ids", "id", 8),
    "delete_payloads_exact": _exact_payload_sql("external_ids", "id"),
    "suppress": with_tables("SELECT * FROM people WHERE external_id NOT IN (SELECT id FROM leaving)", SQL),
    "validate_leads": _leads_sql(
        f"""
    SELECT lead_id, array_to_string(empty, '|') AS empty_fields, array_to_string(errs, '|') AS errors,
           list_extract(errs, 1) AS first_error, CAST(len(errs) = 0 AS INTEGER) AS accepted
    FROM (SELECT lead_id, empty, list_filter([CASE WHEN len(empty) > 0 THEN 'Bitte füllen Sie alle Felder aus.' END,
                 CASE WHEN bad_mail THEN {_MAIL_TEXT} END,
                 CASE WHEN length(zip) > 5 THEN 'Bitte hinterlegen Sie eine gültige Postleitzahl.' END],
                 lambda e: e IS NOT NULL) AS errs
          FROM (SELECT lead_id, zip, {_BAD_MAIL} AS bad_mail, list_filter([{_EMPTY}], lambda e: e IS NOT NULL) AS empty
                FROM lead_rows))"""
    ),
    "validate_leads_short": _leads_sql(
        f"""SELECT lead_id, '' AS empty_fields, CASE WHEN {_BAD_MAIL} THEN {_MAIL_TEXT} ELSE '' END AS errors,
        CASE WHEN {_BAD_MAIL} THEN {_MAIL_TEXT} END AS first_error, CAST(NOT {_BAD_MAIL} AS INTEGER) AS accepted
        FROM lead_rows"""
    ),
    "lead_records": _leads_sql(
        f"""SELECT lead_id, {", ".join(_form(name) for name in lead_plan.URL_FIELDS)},
        'lead-form' AS utm_adgroup, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS datetime FROM lead_rows"""
    ),
    "greeting": f"""
    SELECT c_custkey, CASE WHEN trim(coalesce(n, '')) = '' THEN 'Hey,' ELSE 'Hey ' || n || ',' END AS greeting,
           CASE WHEN c_custkey % 3 = 0 THEN 'Hallo' ELSE 'Hello' END AS hello, CAST(c_custkey % 4 = 0 AS INTEGER) AS flag
    FROM (SELECT c_custkey, {sql_index(BLANKS, "c_custkey % 6")} AS n FROM customer)""",
}
