"""SQL that DuckDB runs on the given tables to state what each query must return.

Layers are common table expressions; a query names its body and gets the layers it mentions.
"""

from __future__ import annotations

import re

DATE_LIKE = "^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{2}$"


def _domain(entity: str, column: str, sentinel: str) -> str:
    return f"""
select min(raw_id) as {entity}_id, arg_min(trim({column}), raw_id) as {entity}_name,
       lower(trim({column})) as {entity}_name_norm
from raw
where trim({column}) not in ('', '{sentinel}')
group by lower(trim({column}))"""


def _dim(entity: str) -> str:
    return f"""
select row_number() over (order by {entity}_id) as {entity}_key, *
from {entity}"""


LAYERS = {
    "raw": """
select k as raw_id,
  case when k % 1000 = 999 then 'SHIFTED ROW'
       when k % 3 = 0 then '  ' || c_name || ' '
       when k % 3 = 1 then upper(c_name)
       else c_name end as app,
  case when k % 1000 = 999 then '1.9' else c_mktsegment end as category,
  case when k % 7 = 0 then 'NaN' when k % 11 = 0 then ''
       else (k % 6) || '.' || (k % 10) end as rating,
  case when k % 1000 = 999 then '3.0M' else (k % 5000)::varchar end as reviews,
  case k % 5 when 0 then 'Varies with device'
             when 1 then (k % 100) || '.' || (k % 10) || 'M'
             when 2 then (k % 900) || 'k'
             when 3 then case when k % 2 = 0 then '' else '1,000+' end
             else (k % 200) || 'm' end as size,
  (k % 9 + 1) || ',000+' as installs,
  case when k % 1000 = 999 then '0' when o_orderstatus = 'F' then 'Free'
       when o_orderstatus = 'O' then 'Paid' end as type,
  case when k % 1000 = 999 then 'Everyone' when k % 101 = 0 then '$4.99'
       when o_orderstatus = 'O' and k % 103 <> 0
       then '$' || o_totalprice::decimal(12,2)::varchar else '0' end as price,
  case when k % 1000 = 999 then '' else substring(o_orderpriority, 3) end as content_rating,
  case when k % 1000 = 999 then '11-Feb-18' when k % 13 = 0 then types || ';'
       when k % 17 = 0 then lower(replace(types, ';', ' ; ')) else types end as genres,
  case when k % 997 = 0 then '' else strftime(o_orderdate, '%-d-%b-%y') end as last_updated,
  case when k % 50 = 0 then 'NaN' when k % 51 = 0 then 'n/a'
       else '1.' || (k % 10) end as current_ver,
  case when k % 53 = 0 then 'null' when k % 59 = 0 then '  '
       else '4.' || (k % 4) || ' and up' end as android_ver
from (select *, o_orderkey as k from orders) o
join customer on c_custkey = o_custkey
left join (
  select l_orderkey, string_agg(distinct p_type, ';' order by p_type) as types
  from lineitem join part on p_partkey = l_partkey
  group by l_orderkey
) t on l_orderkey = k""",
    "category": _domain("category", "category", "1.9"),
    "app_type": _domain("app_type", "type", "0"),
    "content_rating": _domain("content_rating", "content_rating", "0"),
    "app": _domain("app", "app", "SHIFTED ROW"),
    "typed": f"""
select raw_id, lower(trim(app)) as app_norm, lower(trim(category)) as category_norm,
  lower(trim(type)) as type_norm, lower(trim(content_rating)) as content_rating_norm,
  case when regexp_matches(trim(rating), '^[0-9]+(\\.[0-9]+)?$')
        and try_cast(trim(rating) as decimal(38,10)) between 0 and 5
       then try_cast(trim(rating) as decimal(3,2)) end as rating,
  case when regexp_matches(trim(reviews), '^[0-9]+$')
       then try_cast(trim(reviews) as bigint) end as reviews_count,
  case when regexp_matches(trim(size), '^[0-9]+(\\.[0-9]+)?[Mm]$')
       then round(try_cast(regexp_replace(trim(size), '[Mm]', '') as decimal(18,4)) * 1048576)
       when regexp_matches(trim(size), '^[0-9]+(\\.[0-9]+)?[Kk]$')
       then round(try_cast(regexp_replace(trim(size), '[Kk]', '') as decimal(18,4)) * 1024)
       end::bigint as size_bytes,
  try_cast(nullif(regexp_replace(trim(installs), '[^0-9]', '', 'g'), '') as bigint)
    as installs_count,
  try_cast(nullif(regexp_replace(trim(price), '[^0-9.]', '', 'g'), '') as decimal(10,2))
    as price_usd,
  case when regexp_matches(trim(last_updated), '{DATE_LIKE}')
       then try_strptime(trim(last_updated), '%d-%b-%y')::date end as last_updated_date,
  nullif(trim(current_ver), '') as current_version,
  nullif(trim(android_ver), '') as android_version_text
from raw""",
    "snapshot": """
select raw_id as snapshot_id, raw_id, app_id, category_id, app_type_id, content_rating_id,
  rating, reviews_count, size_bytes, installs_count, price_usd, last_updated_date,
  current_version, android_version_text
from typed
join app on app_name_norm = app_norm
left join category on category_name_norm = category_norm
left join app_type on app_type_name_norm = type_norm
left join content_rating on content_rating_name_norm = content_rating_norm""",
    "listed": f"""
select raw_id, trim(v) as value
from (select raw_id, unnest(string_split(genres, ';')) as v from raw) u
where trim(v) <> '' and not regexp_matches(trim(v), '{DATE_LIKE}')""",
    "genre": """
select row_number() over (order by raw_id, genre_name_norm) as genre_id, value as genre_name,
  genre_name_norm
from (
  select *, lower(value) as genre_name_norm,
    row_number() over (partition by lower(value) order by raw_id, value) as place
  from listed
) p
where place = 1""",
    "bridge": """
select distinct snapshot_id, genre_id
from listed
join snapshot using (raw_id)
join genre on genre_name_norm = lower(value)""",
    "enriched": """
select s.snapshot_id, s.raw_id, s.app_id, app_name, app_name_norm, s.category_id, category_name,
  category_name_norm, s.app_type_id, app_type_name, app_type_name_norm, s.content_rating_id,
  content_rating_name, content_rating_name_norm, s.rating, reviews_count, size_bytes,
  installs_count, price_usd, last_updated_date, current_version, android_version_text,
  r.app as raw_app, r.category as raw_category, r.rating as raw_rating, r.reviews as raw_reviews,
  r.size as raw_size, r.installs as raw_installs, r.type as raw_type, r.price as raw_price,
  r.content_rating as raw_content_rating, r.genres as raw_genres,
  r.last_updated as raw_last_updated, r.current_ver as raw_current_version,
  r.android_ver as raw_android_version
from snapshot s
left join app using (app_id)
left join category using (category_id)
left join app_type using (app_type_id)
left join content_rating using (content_rating_id)
left join raw r on r.raw_id = s.raw_id""",
    "genre_counts": """
select s.snapshot_id, count(b.genre_id) as genre_count
from snapshot s left join bridge b on b.snapshot_id = s.snapshot_id
group by s.snapshot_id""",
    "flagged": """
select e.*, genre_count,
  case when lower(trim(current_version)) in ('nan', 'null', 'n/a', 'na', '') then null
       else trim(current_version) end as current_clean,
  case when lower(trim(android_version_text)) in ('nan', 'null', 'n/a', 'na', '') then null
       else trim(android_version_text) end as android_clean,
  rating is null as rating_missing_flag,
  size_bytes is null as size_missing_flag,
  lower(trim(coalesce(raw_size, ''))) = 'varies with device' as size_varies_with_device_flag,
  app_type_id is null as app_type_missing_flag,
  current_clean is null as current_version_missing_flag,
  android_clean is null as android_version_missing_flag,
  (app_type_name_norm = 'free' and price_usd > 0)
    or (app_type_name_norm = 'paid' and coalesce(price_usd, 0) = 0) as type_price_conflict_flag,
  coalesce(rating not between 0 and 5, false) or reviews_count < 0 or installs_count < 0
    or price_usd < 0 or size_bytes < 0 as invalid_measure_flag,
  genre_count = 0 as genre_missing_flag,
  genre_count > 1 as multiple_genre_flag
from enriched e join genre_counts using (snapshot_id)""",
    "clean": """
select snapshot_id, raw_id, app_id, category_id, app_type_id, content_rating_id, rating,
  reviews_count, size_bytes, installs_count, price_usd, last_updated_date,
  current_clean as current_version, android_clean as android_version_text, genre_count,
  rating_missing_flag, size_missing_flag, size_varies_with_device_flag, app_type_missing_flag,
  current_version_missing_flag, android_version_missing_flag, type_price_conflict_flag,
  invalid_measure_flag, genre_missing_flag, multiple_genre_flag,
  (rating_missing_flag::int + size_missing_flag::int + app_type_missing_flag::int
    + current_version_missing_flag::int + android_version_missing_flag::int
    + type_price_conflict_flag::int + invalid_measure_flag::int
    + genre_missing_flag::int)::bigint as dq_issue_count,
  (rating_missing_flag::int + size_missing_flag::int + app_type_missing_flag::int
    + current_version_missing_flag::int + android_version_missing_flag::int
    + coalesce(type_price_conflict_flag, false)::int
    + coalesce(invalid_measure_flag, false)::int
    + genre_missing_flag::int)::bigint as dq_issue_count_strict,
  case when invalid_measure_flag or type_price_conflict_flag or genre_missing_flag
       then 'ERROR_REVIEW'
       when rating_missing_flag or size_missing_flag or app_type_missing_flag
         or current_version_missing_flag or android_version_missing_flag or multiple_genre_flag
       then 'FLAGGED_OK' else 'OK' end as dq_status
from flagged""",
    "clean_bridge": """
select snapshot_id, genre_id,
  round(1::decimal(38,18) * 1000000000000 / count(*) over (partition by snapshot_id))::bigint
    as units
from bridge""",
    "audit_log": """
select 'clean.app_snapshot_clean' as table_name, f.snapshot_id::varchar as row_pk, l.*
from flagged f join raw r using (raw_id), lateral (
  select 'rating' as column_name, 'rating_missing' as issue_type, null::varchar as old_value,
    null::varchar as new_value, 'PRESERVE_AND_FLAG' as action,
    'Rating is an analytical measure. Missing ratings are preserved as NULL to avoid biased imputation; rating_missing_flag is set to true.' as reason
  where f.rating_missing_flag
  union all
  select 'size_bytes',
    case when f.size_varies_with_device_flag then 'size_varies_with_device'
         else 'size_missing' end,
    r.size, f.size_bytes::varchar, 'PRESERVE_AND_FLAG',
    'Application size is missing or reported as "Varies with device". It is preserved as NULL and flagged instead of being imputed.'
  where f.size_missing_flag
  union all
  select 'app_type_id', 'app_type_missing', r.type, null, 'PRESERVE_AND_FLAG',
    'App type is missing in the source. It is not inferred as Free/Paid without a documented business rule.'
  where f.app_type_missing_flag
  union all
  select 'current_version', 'current_version_missing', r.current_ver, f.current_clean,
    'STANDARDIZE_NULL_AND_FLAG',
    'Missing or textual-null current version values are standardized to NULL and flagged.'
  where f.current_version_missing_flag
  union all
  select 'android_version_text', 'android_version_missing', r.android_ver, f.android_clean,
    'STANDARDIZE_NULL_AND_FLAG',
    'Missing or textual-null Android version values are standardized to NULL and flagged.'
  where f.android_version_missing_flag
  union all
  select 'app_type_id / price_usd', 'type_price_conflict',
    'type=' || coalesce(r.type, 'NULL') || '; price=' || coalesce(r.price, 'NULL'),
    'app_type_id=' || coalesce(f.app_type_id::varchar, 'NULL') || '; price_usd='
      || coalesce(f.price_usd::varchar, 'NULL'),
    'FLAG_FOR_REVIEW',
    'Free apps should have price 0 and Paid apps should normally have price greater than 0.'
  where f.type_price_conflict_flag
  union all
  select 'measures', 'invalid_measure',
    'rating=' || coalesce(r.rating, 'NULL') || '; reviews=' || coalesce(r.reviews, 'NULL')
      || '; size=' || coalesce(r.size, 'NULL') || '; installs=' || coalesce(r.installs, 'NULL')
      || '; price=' || coalesce(r.price, 'NULL'),
    'rating=' || coalesce(f.rating::varchar, 'NULL')
      || '; reviews=' || coalesce(f.reviews_count::varchar, 'NULL')
      || '; size=' || coalesce(f.size_bytes::varchar, 'NULL')
      || '; installs=' || coalesce(f.installs_count::varchar, 'NULL')
      || '; price=' || coalesce(f.price_usd::varchar, 'NULL'),
    'FLAG_FOR_REVIEW', 'One or more typed measures violate validity rules.'
  where f.invalid_measure_flag
  union all
  select 'genre_count', 'multiple_genre_membership', f.genre_count::varchar,
    f.genre_count::varchar, 'PRESERVE_AND_USE_WEIGHTED_BRIDGE',
    'The snapshot belongs to multiple genres. This is preserved, and bridge weights are created to avoid double counting in Genre analyses.'
  where f.multiple_genre_flag
) l""",
    "dim_app": _dim("app"),
    "dim_category": _dim("category"),
    "dim_app_type": """
select row_number() over (order by app_type_id) as app_type_key, * from app_type
union all
select (select count(*) from app_type) + 1, null, 'Unknown', 'unknown'""",
    "dim_content_rating": _dim("content_rating"),
    "dim_genre": _dim("genre"),
    "dim_date": """
select row_number() over (order by full_date) as last_updated_date_key, full_date,
  extract(day from full_date)::bigint as day, extract(month from full_date)::bigint as month,
  extract(quarter from full_date)::bigint as quarter,
  extract(year from full_date)::bigint as year, monthname(full_date) as month_name
from (select distinct last_updated_date as full_date from clean
      where last_updated_date is not null) d""",
    "fact": """
select snapshot_id as app_snapshot_key, snapshot_id, raw_id, app_key, category_key,
  coalesce(t.app_type_key, u.app_type_key) as app_type_key, content_rating_key,
  last_updated_date_key, rating, reviews_count, installs_count, price_usd, size_bytes,
  rating_missing_flag, size_missing_flag, size_varies_with_device_flag, app_type_missing_flag,
  current_version_missing_flag, android_version_missing_flag, multiple_genre_flag, dq_status
from clean c
join dim_app using (app_id)
join dim_category using (category_id)
left join dim_app_type t on t.app_type_id = c.app_type_id
join dim_app_type u on u.app_type_name_norm = 'unknown'
join dim_content_rating using (content_rating_id)
join dim_date on full_date = c.last_updated_date""",
    "dw_bridge": """
select app_snapshot_key, genre_key, units
from clean_bridge
join fact using (snapshot_id)
join dim_genre using (genre_id)""",
    "fractional": """
select f.app_snapshot_key, f.snapshot_id, genre_name, units, f.rating, f.reviews_count,
  f.installs_count, f.price_usd, f.size_bytes,
  f.reviews_count::hugeint * units as review_units,
  f.installs_count::hugeint * units as install_units,
  f.rating_missing_flag, f.size_missing_flag, f.size_varies_with_device_flag,
  f.multiple_genre_flag, f.dq_status
from fact f join dw_bridge using (app_snapshot_key) join dim_genre using (genre_key)""",
    "clean_weight_sums": """
select snapshot_id, count(*) as genre_count, sum(units) as units
from clean_bridge group by snapshot_id""",
    "dw_weight_sums": """
select app_snapshot_key, count(*) as genre_count, sum(units) as units
from dw_bridge group by app_snapshot_key""",
    "star": """
select f.app_snapshot_key, f.snapshot_id, f.raw_id, app_name, category_name, app_type_name,
  content_rating_name, full_date as last_updated_date, day, month, quarter, year, f.rating,
  f.reviews_count, f.installs_count, f.price_usd, f.size_bytes, f.rating_missing_flag,
  f.size_missing_flag, f.size_varies_with_device_flag, f.app_type_missing_flag,
  f.current_version_missing_flag, f.android_version_missing_flag, f.multiple_genre_flag,
  f.dq_status
from fact f
join dim_app using (app_key)
join dim_category using (category_key)
join dim_app_type using (app_type_key)
join dim_content_rating using (content_rating_key)
join dim_date using (last_updated_date_key)""",
}

# Layer names that also are column names somewhere are recognised only as tables.
_SOURCE = re.compile(r"(?:from|join)\s+\(?\s*([a-z_0-9]+)")


def _sources(sql: str) -> list[str]:
    return [name for name in _SOURCE.findall(sql) if name in LAYERS]


def _sql(body: str) -> str:
    """The body under the layers it reads, directly or through others."""
    order: list[str] = []

    def need(text: str) -> None:
        for name in _sources(text):
            if name not in order:
                need(LAYERS[name])
                if name not in order:
                    order.append(name)

    need(body)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{name} as materialized ({LAYERS[name]})" for name in order)
    return f"with {parts}\n{body.strip()}"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _metric_rows(metrics: dict[str, str]) -> str:
    return "\nunion all\n".join(
        f"select '{name}' as metric, ({count})::varchar as value" for name, count in metrics.items()
    )


def _count(table: str, where: str = "true") -> str:
    return f"select count(*) from {table} where {where}"


def _mean(column: str) -> str:
    return f"round(sum({column})::double / count({column}), 6)"


def _lines(lines: list[tuple], extra: str) -> str:
    """(dimension, metric, object, total, issues, details, recommendation) with exact scores."""
    rows = "\nunion all\n".join(
        f"select {_text(d)} as dimension, {_text(m)} as metric, {_text(o)} as checked_object, "
        f"({t})::bigint as total_checked, ({i})::bigint as issue_count, "
        f"{_text(det)} as details, {_text(rec)} as recommendation"
        for d, m, o, t, i, det, rec in lines
    )
    # Half up to four places, in whole numbers.
    return f"""
select {extra} total_checked, issue_count, points / 10000.0::double as score,
  case when points is null then 'INFO' when points >= 9500 then 'GREEN'
       when points >= 8000 then 'YELLOW' else 'RED' end as severity, details
from (
  select *, case when total_checked > 0 then
    ((total_checked - issue_count) * 20000 + total_checked) // (2 * total_checked) end as points
  from (
{rows}
  ) r
) s"""


def _baseline() -> str:
    snap = "reconciled.app_snapshot"
    rows = _count("snapshot")

    def excess(table: str, keys: str) -> str:
        return (
            f"select coalesce(sum(n - 1), 0) from "
            f"(select count(*) as n from {table} group by {keys}) d"
        )

    # Dimensions, metric names, checked objects, details and recommendations.
    lines = [
        ("Completeness", "core_required_fields_missing", snap, rows,
         _count("snapshot", "app_id is null or category_id is null or content_rating_id is null or reviews_count is null or installs_count is null or price_usd is null or last_updated_date is null"),
         "Core fields should be present for each loaded app snapshot. Rating and size are excluded because missing values are analytically meaningful.",
         "Investigate rows with missing core fields before loading the DW fact table."),
        ("Completeness", "rating_missing", f"{snap}.rating", rows, _count("snapshot", "rating is null"),
         "Rating can be missing in the source dataset. It should not be blindly imputed because it is an analytical measure.",
         "Preserve NULL rating and create rating_missing_flag during cleaning."),
        ("Completeness", "size_missing_or_varies_with_device", f"{snap}.size_bytes", rows, _count("snapshot", "size_bytes is null"),
         'Size is NULL when the raw value is missing or equal to "Varies with device". This is meaningful source information.',
         "Preserve NULL size and create size_missing_or_varies_flag during cleaning."),
        ("Completeness", "app_type_missing", f"{snap}.app_type_id", rows, _count("snapshot", "app_type_id is null"),
         "App type should usually be Free or Paid. Missing type should be flagged instead of guessed.",
         "Create app_type_missing_flag. Do not infer Free/Paid unless a documented business rule is approved."),
        ("Completeness", "current_version_missing", f"{snap}.current_version", rows,
         _count("snapshot", "current_version is null or lower(trim(current_version)) in ('', 'nan', 'null')"),
         "Current version is descriptive metadata and may be missing for some apps.",
         "Preserve missing value and optionally flag it for metadata-quality analysis."),
        ("Completeness", "android_version_missing", f"{snap}.android_version_text", rows,
         _count("snapshot", "android_version_text is null or lower(trim(android_version_text)) in ('', 'nan', 'null')"),
         "Android version is descriptive metadata and may be missing or vary across devices.",
         "Preserve missing value and optionally flag it for metadata-quality analysis."),
        ("Uniqueness", "duplicate_raw_id_in_app_snapshot", f"{snap}.raw_id", rows, excess("snapshot", "raw_id"),
         "Each raw row should generate at most one reconciled app snapshot.",
         "If duplicates exist, inspect ETL joins and source row identifiers."),
        ("Uniqueness", "duplicate_app_name_norm", "reconciled.app.app_name_norm", _count("app"), excess("app", "app_name_norm"),
         "Normalized app names should be unique in the app master table.",
         "If duplicates exist, improve normalization rules."),
        ("Uniqueness", "duplicate_snapshot_genre_pair", f"{snap}_genre(snapshot_id, genre_id)", _count("bridge"), excess("bridge", "snapshot_id, genre_id"),
         "Each snapshot-genre pair should appear only once.",
         "If duplicates exist, deduplicate the bridge table before DW loading."),
        ("Validity", "rating_out_of_range", f"{snap}.rating", rows, _count("snapshot", "rating < 0 or rating > 5"),
         "Rating must be between 0 and 5.",
         "Invalid ratings should be set to NULL and logged during cleaning."),
        ("Validity", "negative_reviews_count", f"{snap}.reviews_count", rows, _count("snapshot", "reviews_count < 0"),
         "Review count cannot be negative.",
         "Invalid review counts should be investigated and nullified if needed."),
        ("Validity", "negative_installs_count", f"{snap}.installs_count", rows, _count("snapshot", "installs_count < 0"),
         "Install count cannot be negative.",
         "Invalid install counts should be investigated and nullified if needed."),
        ("Validity", "negative_price_usd", f"{snap}.price_usd", rows, _count("snapshot", "price_usd < 0"),
         "Price cannot be negative.",
         "Invalid prices should be set to NULL or corrected from source if possible."),
        ("Validity", "negative_size_bytes", f"{snap}.size_bytes", rows, _count("snapshot", "size_bytes < 0"),
         "Application size in bytes cannot be negative.",
         "Invalid sizes should be set to NULL and logged."),
        ("Validity", "invalid_domain_values_after_load", "reconciled domain tables",
         f"({_count('category')}) + ({_count('app_type')}) + ({_count('content_rating')})",
         "(select count(*) from category where category_name_norm in ('1.9', 'nan', 'null', '0', ''))"
         " + (select count(*) from app_type where app_type_name_norm not in ('free', 'paid'))"
         " + (select count(*) from content_rating where content_rating_name_norm in ('nan', 'null', '0', ''))",
         "Domain tables should not contain shifted row values or textual null markers.",
         "If issues exist, fix domain-load filters and rerun the reconciled load."),
        ("Consistency", "type_price_conflict", f"{snap} + reconciled.app_type", rows, _count("flagged", "type_price_conflict_flag"),
         "Free apps should have price 0. Paid apps should usually have price greater than 0.",
         "Rows with Type/Price conflicts should be flagged and inspected."),
        ("Consistency", "snapshot_without_genre", f"{snap} vs {snap}_genre", rows, _count("genre_counts", "genre_count = 0"),
         "Each snapshot should have at least one genre according to the source dataset.",
         "If missing, inspect raw Genres and bridge ETL."),
        ("Consistency", "orphan_snapshot_genre_rows", f"{snap}_genre foreign-key consistency", _count("bridge"),
         _count("bridge", "snapshot_id not in (select snapshot_id from snapshot) or genre_id not in (select genre_id from genre)"),
         "Bridge rows must reference existing snapshots and existing genres.",
         "Orphan bridge rows must be removed before DW loading."),
        ("Timeliness", "future_last_updated_date", f"{snap}.last_updated_date", rows, _count("snapshot", "last_updated_date > current_date"),
         "Last updated date should not be in the future.",
         "Future dates should be corrected if source evidence exists, otherwise nullified and logged."),
        ("Timeliness", "last_updated_date_missing", f"{snap}.last_updated_date", rows, _count("snapshot", "last_updated_date is null"),
         "Last updated date supports the time dimension and should be present.",
         "Missing update dates must be investigated before DW loading."),
        ("Accuracy", "external_ground_truth_not_available", "Catalogue source values", "null", "null",
         "Accuracy cannot be fully verified without an external trusted source such as current Catalogue metadata.",
         "Document this limitation. Use validity, consistency, and outlier checks as internal proxies only."),
    ]
    return _lines(lines, "dimension, metric, checked_object, recommendation,")


def _after_cleaning() -> str:
    rows = _count("clean")
    managed = "Completeness Management"
    # Dimensions, metric names and details.
    lines = [
        (managed, "rating_missing_values_are_flagged", rows, _count("clean", "rating is null and rating_missing_flag is not true"),
         "All NULL ratings must be explicitly flagged."),
        (managed, "size_missing_values_are_flagged", rows, _count("clean", "size_bytes is null and size_missing_flag is not true"),
         "All NULL size values must be explicitly flagged."),
        (managed, "app_type_missing_values_are_flagged", rows, _count("clean", "app_type_id is null and app_type_missing_flag is not true"),
         "All missing app type values must be explicitly flagged."),
        ("Validity", "invalid_measures_remaining", rows, _count("clean", "invalid_measure_flag"),
         "Invalid typed measures should not exist after the reconciled ETL."),
        ("Consistency", "type_price_conflicts_remaining", rows, _count("clean", "type_price_conflict_flag"),
         "Free/Paid type should be consistent with price."),
        ("Consistency", "genre_missing_remaining", rows, _count("clean", "genre_missing_flag"),
         "Every app snapshot should have at least one genre."),
        ("Many-to-Many Integrity", "genre_bridge_weight_errors", rows, _count("clean_weight_sums", "abs(units - 1000000000000) > 1000000"),
         "For each snapshot, the sum of Genre bridge weights must be equal to 1."),
        ("Reconciliation", "clean_rows_match_reconciled_rows", "1",
         f"case when ({_count('clean')}) = ({_count('snapshot')}) then 0 else 1 end",
         "Clean layer should preserve the reconciled snapshot grain."),
    ]
    return _lines(
        [(d, m, "", t, i, det, "") for d, m, t, i, det in lines], "dimension, metric,"
    )


def _checks(lines: list[tuple], id_column: bool = True) -> str:
    """(id, name, expected, actual[, passed]) as PASS/FAIL rows."""
    bodies = []
    for line in lines:
        check_id, name, expected, actual = line[:4]
        passed = line[4] if len(line) > 4 else f"({expected}) = ({actual})"
        ids = f"'{check_id}' as check_id, " if id_column else ""
        names = ("expected", "actual") if id_column else ("expected_value", "actual_value")
        bodies.append(
            f"select {ids}'{name}' as check_name, round(({expected})::double, 6) as {names[0]}, "
            f"round(({actual})::double, 6) as {names[1]}, "
            f"case when {passed} then 'PASS' else 'FAIL' end as status"
        )
    return "\nunion all\n".join(bodies)


def _twice(table: str, keys: str) -> str:
    return (
        f"select count(*) from (select {keys} from {table} group by {keys} "
        "having count(*) > 1) d"
    )


def _missing(child: str, key: str, parent: str) -> str:
    return f"select count(*) from {child} where {key} not in (select {key} from {parent})"


UNKNOWN_FACTS = (
    "select count(*) from fact join dim_app_type using (app_type_key) "
    "where app_type_name_norm = 'unknown'"
)
CLEAN_OFF = "abs(units - 1000000000000) > 1000000"

INTEGRITY = [
    ("", "fact_rows_match_clean_rows", _count("clean"), _count("fact")),
    ("", "bridge_rows_match_clean_bridge_rows", _count("clean_bridge"), _count("dw_bridge")),
    ("", "genre_bridge_weight_errors", "0", _count("dw_weight_sums", CLEAN_OFF)),
    ("", "fact_duplicate_snapshot_id", "0", _twice("fact", "snapshot_id")),
    ("", "fact_error_review_rows", "0", _count("fact", "dq_status = 'ERROR_REVIEW'")),
]

COUNT_CHECKS = [
    ("P2-COUNT-01", "raw rows are preserved", "(select count(*) from orders)", _count("raw")),
    ("P2-COUNT-02", "reconciled snapshot rows",
     _count("raw", "trim(app) <> '' and trim(app) <> 'SHIFTED ROW'"), _count("snapshot")),
    ("P2-COUNT-03", "clean snapshot rows match reconciled snapshot rows", _count("snapshot"), _count("clean")),
    ("P2-COUNT-04", "clean bridge rows match reconciled bridge rows", _count("bridge"), _count("clean_bridge")),
    ("P2-COUNT-05", "fact rows match clean snapshot rows", _count("clean"), _count("fact")),
    ("P2-COUNT-06", "dw bridge rows match clean bridge rows", _count("clean_bridge"), _count("dw_bridge")),
    ("P2-COUNT-07", "dim_app rows match reconciled.app rows", _count("app"), _count("dim_app")),
    ("P2-COUNT-08", "dim_category rows match reconciled.category rows", _count("category"), _count("dim_category")),
    ("P2-COUNT-09", "dim_app_type rows include Unknown technical row", f"({_count('app_type')}) + 1", _count("dim_app_type")),
    ("P2-COUNT-10", "dim_content_rating rows match reconciled.content_rating rows", _count("content_rating"), _count("dim_content_rating")),
    ("P2-COUNT-11", "dim_genre rows match reconciled.genre rows", _count("genre"), _count("dim_genre")),
    ("P2-COUNT-12", "dim_last_updated_date rows match distinct clean dates", "select count(distinct last_updated_date) from clean", _count("dim_date")),
]

CLEAN_CHECKS = [
    ("P2-CLEAN-01", "NULL ratings are flagged", "0", _count("clean", "rating is null and rating_missing_flag is not true")),
    ("P2-CLEAN-02", "NULL sizes are flagged", "0", _count("clean", "size_bytes is null and size_missing_flag is not true")),
    ("P2-CLEAN-03", "missing app types are flagged", "0", _count("clean", "app_type_id is null and app_type_missing_flag is not true")),
    ("P2-CLEAN-04", "invalid measures remaining", "0", _count("clean", "invalid_measure_flag")),
    ("P2-CLEAN-05", "type price conflicts remaining", "0", _count("clean", "type_price_conflict_flag")),
    ("P2-CLEAN-06", "snapshots without genre remaining", "0", _count("clean", "genre_missing_flag")),
    ("P2-CLEAN-07", "audit log rows match all logged flag rows",
     "select sum(rating_missing_flag::int + size_missing_flag::int + app_type_missing_flag::int "
     "+ current_version_missing_flag::int + android_version_missing_flag::int "
     "+ coalesce(type_price_conflict_flag, false)::int + coalesce(invalid_measure_flag, false)::int "
     "+ multiple_genre_flag::int) from clean", _count("audit_log")),
    ("P2-CLEAN-08", "ERROR_REVIEW rows after cleaning", "0", _count("clean", "dq_status = 'ERROR_REVIEW'")),
]

BRIDGE_CHECKS = [
    ("P2-BRIDGE-01", "clean bridge orphan snapshot rows", "0", _missing("clean_bridge", "snapshot_id", "clean")),
    ("P2-BRIDGE-02", "clean bridge orphan genre rows", "0", _missing("clean_bridge", "genre_id", "genre")),
    ("P2-BRIDGE-03", "duplicate clean bridge pairs", "0", _twice("clean_bridge", "snapshot_id, genre_id")),
    ("P2-BRIDGE-04", "invalid clean bridge weights", "0", _count("clean_bridge", "units <= 0 or units > 1000000000000")),
    ("P2-BRIDGE-05", "clean bridge weight sum errors", "0", _count("clean_weight_sums", CLEAN_OFF)),
]

DW_CHECKS = [
    ("P2-DW-01", "fact orphan app_key rows", "0", _missing("fact", "app_key", "dim_app")),
    ("P2-DW-02", "fact orphan category_key rows", "0", _missing("fact", "category_key", "dim_category")),
    ("P2-DW-03", "fact orphan app_type_key rows", "0", _missing("fact", "app_type_key", "dim_app_type")),
    ("P2-DW-04", "fact orphan content_rating_key rows", "0", _missing("fact", "content_rating_key", "dim_content_rating")),
    ("P2-DW-05", "fact orphan date_key rows", "0", _missing("fact", "last_updated_date_key", "dim_date")),
    ("P2-DW-06", "bridge orphan fact rows", "0", _missing("dw_bridge", "app_snapshot_key", "fact")),
    ("P2-DW-07", "bridge orphan genre rows", "0", _missing("dw_bridge", "genre_key", "dim_genre")),
    ("P2-DW-08", "duplicate fact snapshot_id rows", "0", _twice("fact", "snapshot_id")),
    ("P2-DW-09", "unknown app type fact rows match clean missing app type rows", _count("clean", "app_type_missing_flag"), UNKNOWN_FACTS),
]


def _weight_checks(relative: bool = True) -> str:
    weights = "(select sum(units) from dw_bridge)"
    facts = "(select count(*) from fact)"

    def measure(check_id: str, name: str) -> tuple:
        units = f"(select coalesce(sum({name}_units), 0) from fractional)"
        column = f"{name}s_count"
        total = f"(select coalesce(sum({column}), 0) from fact)"
        return (
            check_id, f"weighted {name}s equal fact {name}s", total,
            f"{units}::double / 1e12",
            f"abs({units} - {total} * 1000000000000) <= 100000000000000"
            + (f" * greatest(round({total} / 1e6), 1)" if relative else ""),
        )

    return _checks([
        ("P2-WEIGHT-01", "dw bridge weight sum errors", "0", _count("dw_weight_sums", CLEAN_OFF)),
        ("P2-WEIGHT-02", "weighted snapshot count equals fact row count", facts,
         f"{weights}::double / 1e12",
         f"abs({weights} - {facts} * 1000000000000) <= 1000000"
         + (f" * greatest({facts}, 1)" if relative else "")),
        measure("P2-WEIGHT-03", "review"),
        measure("P2-WEIGHT-04", "install"),
    ])


def _constraint_rows(rules: list[tuple[str, str]]) -> str:
    return "\nunion all\n".join(
        f"select '{name}' as constraint_name, ({sql})::bigint as violations"
        for name, sql in rules
    )


MASTERS = ("app", "category", "app_type", "content_rating")
# Name of the date dimension in the results.
DATE_DIM = "dim_last_updated_date"
DIMS = {**{m: f"dim_{m}" for m in (*MASTERS, "genre")}, "last_updated_date": "dim_date"}


def _unique() -> str:
    keys = [
        *[(m, m, f"{m}_id") for m in (*MASTERS, "genre")],
        *[(m, m, f"{m}_name_norm") for m in (*MASTERS, "genre")],
        ("raw", "raw", "raw_id"),
        ("snapshot", "snapshot", "snapshot_id"),
        ("snapshot", "snapshot", "raw_id"),
        ("bridge", "bridge", "snapshot_id, genre_id"),
        ("clean", "clean", "snapshot_id"),
        ("clean_bridge", "clean_bridge", "snapshot_id, genre_id"),
        *[(f"dim_{d}", table, f"{d}_key") for d, table in DIMS.items()],
        *[(f"dim_{m}", f"dim_{m}", f"{m}_id") for m in (*MASTERS, "genre")],
        ("dim_app_type", "dim_app_type", "app_type_name"),
        (DATE_DIM, "dim_date", "full_date"),
        ("fact", "fact", "app_snapshot_key"),
        ("fact", "fact", "snapshot_id"),
        ("dw_bridge", "dw_bridge", "app_snapshot_key, genre_key"),
    ]
    rules = []
    for shown, table, columns in keys:
        filled = " and ".join(f"{c} is not null" for c in columns.split(", "))
        rules.append((
            f"unique {shown}({columns})",
            f"select coalesce(sum(n - 1), 0) from (select count(*) as n from {table} "
            f"where {filled} group by {columns}) d",
        ))
    return _constraint_rows(rules)


def _foreign() -> str:
    keys = [
        ("snapshot", "raw_id", "raw", "raw"),
        *[("snapshot", f"{m}_id", m, m) for m in MASTERS],
        ("bridge", "snapshot_id", "snapshot", "snapshot"),
        ("bridge", "genre_id", "genre", "genre"),
        ("clean_bridge", "snapshot_id", "clean", "clean"),
        ("clean_bridge", "genre_id", "genre", "genre"),
        *[("fact", f"{m}_key", f"dim_{m}", f"dim_{m}") for m in MASTERS],
        ("fact", "last_updated_date_key", DATE_DIM, "dim_date"),
        ("dw_bridge", "app_snapshot_key", "fact", "fact"),
        ("dw_bridge", "genre_key", "dim_genre", "dim_genre"),
    ]
    return _constraint_rows([
        (f"foreign key {child}({key}) in {shown}",
         f"{_missing(child, key, parent)} and {key} is not null")
        for child, key, shown, parent in keys
    ])


def _check_constraints() -> str:
    measures = {
        "rating": "rating not between 0 and 5",
        **{c: f"{c} < 0" for c in ("reviews_count", "installs_count", "price_usd", "size_bytes")},
    }
    rules = [(f"check snapshot({c})", _count("snapshot", bad)) for c, bad in measures.items()]
    for column, bad in (
        ("day", "day not between 1 and 31"), ("month", "month not between 1 and 12"),
        ("quarter", "quarter not between 1 and 4"), ("year", "year < 1900"),
    ):
        rules.append((f"check {DATE_DIM}({column})", _count("dim_date", bad)))
    rules += [(f"check fact({c})", _count("fact", bad)) for c, bad in measures.items()]
    rules.append((
        "check fact(dq_status)",
        _count("fact", "dq_status not in ('OK', 'FLAGGED_OK', 'ERROR_REVIEW')"),
    ))
    rules.append((
        "check dw_bridge(weight)", _count("dw_bridge", "units <= 0 or units > 1000000000000")
    ))
    return _constraint_rows(rules)


def _not_null() -> str:
    flags = (
        "rating_missing_flag", "size_missing_flag", "size_varies_with_device_flag",
        "app_type_missing_flag", "current_version_missing_flag", "android_version_missing_flag",
        "multiple_genre_flag",
    )
    filled = [
        *[(m, m, (f"{m}_id", f"{m}_name", f"{m}_name_norm")) for m in (*MASTERS, "genre")],
        ("snapshot", "snapshot", ("snapshot_id", "raw_id", "app_id")),
        ("bridge", "bridge", ("snapshot_id", "genre_id")),
        ("audit_log", "audit_log", ("table_name", "row_pk", "issue_type", "action", "reason")),
        *[
            (f"dim_{m}", f"dim_{m}",
             (f"{m}_key", f"{m}_name", *(() if m == "app_type" else (f"{m}_id",))))
            for m in (*MASTERS, "genre")
        ],
        (DATE_DIM, "dim_date",
         ("last_updated_date_key", "full_date", "day", "month", "quarter", "year", "month_name")),
        ("fact", "fact",
         ("app_snapshot_key", "snapshot_id", *[f"{m}_key" for m in MASTERS],
          "last_updated_date_key", *flags, "dq_status")),
        ("dw_bridge", "dw_bridge", ("app_snapshot_key", "genre_key", "weight")),
    ]
    return _constraint_rows([
        (f"not null {shown}({c})",
         _count(table, f"{'units' if c == 'weight' else c} is null"))
        for shown, table, columns in filled
        for c in columns
    ])


def _measures_by(column: str) -> str:
    return f"""
select {column}, count(*) as snapshot_count, {_mean('rating')} as avg_rating,
  sum(reviews_count)::double as sum_reviews, sum(installs_count)::double as sum_installs,
  {_mean('price_usd')} as avg_price_usd, {_mean('size_bytes')} as avg_size_bytes
from star group by {column}"""


KPIS = f"""
select genre_name, round(sum(units)::double / 1e12, 6) as weighted_snapshot_count,
  round(sum(review_units)::double / 1e12, 6) as weighted_reviews_count,
  round(sum(install_units)::double / 1e12, 6) as weighted_installs_count,
  {_mean('rating')} as avg_rating_unweighted,
  round(sum((rating * 100)::bigint * units)::double
    / nullif(sum(units) filter (where rating is not null), 0) / 100, 6) as avg_rating_weighted
from fractional group by genre_name"""

STAGE_ONE = {
    "raw_rows": _count("raw"),
    "sentinel_raw_rows": _count("raw", "category = '1.9'"),
    "category_rows": _count("category"),
    "app_type_rows": _count("app_type"),
    "content_rating_rows": _count("content_rating"),
    "app_rows": _count("app"),
    "dirty_categories": _count("category", "category_name_norm in ('1.9', 'nan', 'null', '0')"),
    "dirty_app_types": _count("app_type", "app_type_name_norm not in ('free', 'paid')"),
    "sentinel_apps": _count("app", "app_name_norm like 'shifted row%'"),
    "app_snapshot_rows": _count("snapshot"),
    "excluded_raw_rows": _missing("raw", "raw_id", "snapshot"),
    "null_app_id": _count("snapshot", "app_id is null"),
    "null_category_id": _count("snapshot", "category_id is null"),
    "null_app_type_id": _count("snapshot", "app_type_id is null"),
    "null_content_rating_id": _count("snapshot", "content_rating_id is null"),
    "bad_rating": _count("snapshot", "rating < 0 or rating > 5"),
    "bad_reviews": _count("snapshot", "reviews_count < 0"),
    "bad_size": _count("snapshot", "size_bytes < 0"),
    "bad_installs": _count("snapshot", "installs_count < 0"),
    "bad_price": _count("snapshot", "price_usd < 0"),
    "null_last_updated_date": _count("snapshot", "last_updated_date is null"),
    "genre_rows": _count("genre"),
    "app_snapshot_genre_rows": _count("bridge"),
    "snapshots_with_genre": "select count(distinct snapshot_id) from bridge",
    "orphan_bridge_snapshots": _missing("bridge", "snapshot_id", "snapshot"),
    "orphan_bridge_genres": _missing("bridge", "genre_id", "genre"),
    "bad_genres": _count(
        "genre",
        "regexp_matches(genre_name_norm, '^[0-9]{1,2}-[a-z]{3}-[0-9]{2}$') "
        "or genre_name_norm in ('nan', 'null', '')",
    ),
}

CLEANING_SUMMARY = {
    "clean_app_snapshot_rows": _count("clean"),
    "clean_bridge_rows": _count("clean_bridge"),
    "audit_log_rows": _count("audit_log"),
    **{
        f"{f}_flag_rows": _count("clean", f"{f}_flag")
        for f in (
            "rating_missing", "size_missing", "size_varies_with_device", "app_type_missing",
            "current_version_missing", "android_version_missing", "type_price_conflict",
            "invalid_measure", "genre_missing", "multiple_genre",
        )
    },
    "dq_status_ok_rows": _count("clean", "dq_status = 'OK'"),
    "dq_status_flagged_ok_rows": _count("clean", "dq_status = 'FLAGGED_OK'"),
    "dq_status_error_review_rows": _count("clean", "dq_status = 'ERROR_REVIEW'"),
}

LOAD_SUMMARY = {
    **{f"dim_{d}_rows": _count(table) for d, table in DIMS.items()},
    "fact_app_snapshot_rows": _count("fact"),
    "bridge_app_snapshot_genre_rows": _count("dw_bridge"),
    "unknown_app_type_fact_rows": UNKNOWN_FACTS,
    "fact_rating_missing_flag_rows": _count("fact", "rating_missing_flag"),
    "fact_size_missing_flag_rows": _count("fact", "size_missing_flag"),
    "fact_multiple_genre_flag_rows": _count("fact", "multiple_genre_flag"),
}

RECONCILIATION = {
    "raw_rows": _count("raw"),
    "reconciled_app_rows": _count("app"),
    "reconciled_category_rows": _count("category"),
    "reconciled_app_type_rows": _count("app_type"),
    "reconciled_content_rating_rows": _count("content_rating"),
    "reconciled_app_snapshot_rows": _count("snapshot"),
    "reconciled_genre_rows": _count("genre"),
    "reconciled_app_snapshot_genre_rows": _count("bridge"),
    "raw_rows_not_loaded_to_snapshot": _missing("raw", "raw_id", "snapshot"),
}

SNAPSHOT_VALUES = "rating::double as rating, price_usd::double as price_usd"
AS_PLAIN = f"* replace ({SNAPSHOT_VALUES})"
PREVIEW = """
select snapshot_id, genre_id, genre_name,
  count(*) over (partition by snapshot_id) as genre_count_for_snapshot,
  round(1.0::double / count(*) over (partition by snapshot_id), 6) as future_dw_bridge_weight
from bridge join genre using (genre_id)"""

BODIES = {
    "a1_landing": "select * from raw",
    "a1_csv_landing": "select * replace (row_number() over (order by raw_id) as raw_id) from raw",
    "a1_malformed_rows": """
select line as raw_id, app, raw_id % 97 = 0 as surplus
from (select raw_id, app, row_number() over (order by raw_id) as line from raw)
where raw_id % 97 = 0 or raw_id % 101 = 0""",
    "a6_export": _measures_by("category_name"),
    "j01_domain_category": "select * from category",
    "j02_domain_app_type": "select * from app_type",
    "j03_domain_content_rating": "select * from content_rating",
    "j04_domain_app": "select * from app",
    "j05_insert_if_absent": """
select min(c_custkey) as category_id,
  arg_min(trim(c_mktsegment), c_custkey) as category_name,
  lower(trim(c_mktsegment)) as category_name_norm
from customer where trim(c_mktsegment) <> '' group by lower(trim(c_mktsegment))
union all
select (select max(id) from (
    select min(c_custkey) as id from customer where trim(c_mktsegment) <> ''
    group by lower(trim(c_mktsegment)))) + row_number() over (order by min(raw_id)),
  arg_min(trim(category), raw_id), lower(trim(category))
from raw
where trim(category) <> ''
  and lower(trim(category)) not in (
    select lower(trim(c_mktsegment)) from customer where trim(c_mktsegment) <> '')
group by lower(trim(category))""",
    "j06_parse_rating": "select raw_id, rating::double as rating from typed",
    "j07_parse_count": "select raw_id, reviews_count from typed",
    "j08_parse_size": "select raw_id, size_bytes from typed",
    "j09_parse_installs": "select raw_id, installs_count from typed",
    "j10_parse_price": "select raw_id, price_usd::double as price_usd from typed",
    "j11_parse_date": "select raw_id, last_updated_date from typed",
    "j12_parse_text": "select raw_id, current_version, android_version_text from typed",
    "j12_unreadable_cells": f"""
select raw_id, column_name, raw_value from (
  select t.raw_id, 'reviews_count' as column_name, r.reviews as raw_value
  from typed t join raw r using (raw_id)
  where t.reviews_count is null and regexp_matches(trim(r.reviews), '^[0-9]+$')
  union all
  select t.raw_id, 'size_bytes', r.size from typed t join raw r using (raw_id)
  where t.size_bytes is null and regexp_matches(trim(r.size), '^[0-9]+(\\.[0-9]+)?[MmKk]$')
  union all
  select t.raw_id, 'installs_count', r.installs from typed t join raw r using (raw_id)
  where t.installs_count is null and regexp_matches(r.installs, '[0-9]')
  union all
  select t.raw_id, 'price_usd', r.price from typed t join raw r using (raw_id)
  where t.price_usd is null and regexp_matches(r.price, '[0-9.]')
  union all
  select t.raw_id, 'last_updated_date', r.last_updated from typed t join raw r using (raw_id)
  where t.last_updated_date is null and regexp_matches(trim(r.last_updated), '{DATE_LIKE}')
) u""",
    "j13_snapshot": f"select {AS_PLAIN} from snapshot",
    "j14_genre": "select * from genre",
    "j15_bridge": "select * from bridge",
    "j16_reconciliation_counts": _metric_rows(RECONCILIATION),
    "j17_enriched_snapshot": f"select {AS_PLAIN} from enriched",
    "j18_baseline_scorecard": _baseline(),
    "j19_issue_missing_rating": f"select {AS_PLAIN} from enriched where rating is null",
    "j20_issue_missing_size": f"select {AS_PLAIN} from enriched where size_bytes is null",
    "j21_issue_missing_app_type": f"select {AS_PLAIN} from enriched where app_type_id is null",
    "j22_issue_type_price_conflict": f"""
select {AS_PLAIN} from enriched
where (app_type_name_norm = 'free' and price_usd > 0)
   or (app_type_name_norm = 'paid' and coalesce(price_usd, 0) = 0)""",
    "j23_issue_invalid_measures": f"""
select {AS_PLAIN} from enriched
where rating < 0 or rating > 5 or reviews_count < 0 or installs_count < 0 or price_usd < 0
   or size_bytes < 0""",
    "j24_raw_rows_not_loaded":
        "select * from raw where raw_id not in (select raw_id from snapshot)",
    "j25_genre_histogram":
        "select genre_count, count(*) as snapshot_count from genre_counts group by genre_count",
    "j26_weight_preview": PREVIEW,
    "j27_weight_preview_check": f"""
select snapshot_id, count(*) as genre_count, sum(future_dw_bridge_weight) as weight_sum
from ({PREVIEW}) p group by snapshot_id
having abs(sum(future_dw_bridge_weight) - 1) > 0.0001""",
    "j28_version_tokens": "select snapshot_id, current_version, android_version_text from clean",
    "j29_flags": "select snapshot_id, columns('.*_flag') from clean",
    "j30_issue_count": "select snapshot_id, dq_issue_count, dq_issue_count_strict from clean",
    "j31_status": "select dq_status, count(*) as n from clean group by dq_status",
    "j32_clean_snapshot": f"select {AS_PLAIN} from clean",
    "j33_clean_bridge":
        "select snapshot_id, genre_id, units::double / 1e12 as weight from clean_bridge",
    "j34_audit_log": "select * from audit_log",
    "j35_cleaning_summary": _metric_rows(CLEANING_SUMMARY),
    "j36_audit_summary": """
select issue_type, action, count(*) as row_count from audit_log group by issue_type, action""",
    "j37_clean_weight_errors": f"""
select snapshot_id, genre_count, units / 1e12 as weight_sum,
  abs(units - 1000000000000) / 1e12 as weight_error
from clean_weight_sums where {CLEAN_OFF}""",
    "j38_after_cleaning_scorecard": _after_cleaning(),
    "j39_dim_app": "select * from dim_app",
    "j40_dim_category": "select * from dim_category",
    "j41_j44_dim_app_type": "select * from dim_app_type",
    "j42_dim_content_rating": "select * from dim_content_rating",
    "j43_dim_genre": "select * from dim_genre",
    "j45_dim_date": "select * from dim_date",
    "j46_fact": f"select {AS_PLAIN} from fact",
    "j46_fact_unknown_date": """
select snapshot_id,
  coalesce(last_updated_date_key, (select count(*) from dim_date) + 1) as last_updated_date_key
from clean left join dim_date on full_date = last_updated_date
where category_id is not null and content_rating_id is not null""",
    "j47_dw_bridge":
        "select app_snapshot_key, genre_key, units::double / 1e12 as weight from dw_bridge",
    "j48_load_summary": _metric_rows(LOAD_SUMMARY),
    "j49_integrity_checks": _checks(INTEGRITY, id_column=False),
    "j50_enriched_fact": f"select {AS_PLAIN} from star",
    "f2_ordered_key": """
select row_number() over (order by o_orderstatus, o_orderdate::date, o_orderkey) as order_no,
  o_orderkey
from orders""",
    # Loaded in parts, the facts are those of all rows loaded at once.
    "a2_append": f"select {AS_PLAIN} from star",
    "j51_genre_fractional": """
select app_snapshot_key, snapshot_id, genre_name, units::double / 1e12 as weight,
  rating::double as rating, reviews_count, installs_count, price_usd::double as price_usd,
  size_bytes, round(review_units::double / 1e12, 6) as weighted_reviews_count,
  round(install_units::double / 1e12, 6) as weighted_installs_count,
  round(units::double / 1e12, 6) as weighted_snapshot_count, rating_missing_flag,
  size_missing_flag, size_varies_with_device_flag, multiple_genre_flag, dq_status
from fractional""",
    "j52_genre_membership": f"""
select genre_name, count(distinct app_snapshot_key) as snapshot_membership_count,
  {_mean('rating')} as avg_rating, {_mean('price_usd')} as avg_price_usd,
  {_mean('size_bytes')} as avg_size_bytes
from fractional group by genre_name""",
    "j53_genre_weighted_kpis": KPIS,
    "j53_weighted_mean_exact": """
select genre_name, (q // s)::varchar || '.' || lpad((q % s)::varchar, 16, '0') as mean
from (
  select genre_name, 10000000000000000::hugeint as s,
    (2 * top * 100000000000000 + bottom) // (2 * bottom) as q
  from (
    select genre_name, sum((rating * 100)::hugeint * units::hugeint) as top,
      sum(units::hugeint) filter (where rating is not null) as bottom
    from fractional group by genre_name))""",
    "j54_dw_weight_errors": f"""
select app_snapshot_key, genre_count, units / 1e12 as weight_sum,
  abs(units - 1000000000000) / 1e12 as weight_error
from dw_weight_sums where {CLEAN_OFF}""",
    "j56_count_checks": _checks(COUNT_CHECKS),
    "j57_cleaning_checks": _checks(CLEAN_CHECKS),
    "j58_bridge_checks": _checks(BRIDGE_CHECKS),
    "j59_warehouse_checks": _checks(DW_CHECKS),
    "j60_weight_checks": _weight_checks(),
    "j60_weight_checks_flat": _weight_checks(relative=False),
    "j61_must_be_empty": f"""
select 'clean_weight_errors' as set_name,
  (select count(*) from clean_weight_sums where {CLEAN_OFF}) as row_count
union all
select 'dw_weight_errors', (select count(*) from dw_weight_sums where {CLEAN_OFF})
union all
select 'non_green_metrics',
  (select count(*) from ({_after_cleaning()}) a where severity not in ('GREEN', 'INFO'))
union all
select 'integrity_failures',
  (select count(*) from ({_checks(INTEGRITY, id_column=False)}) i where status <> 'PASS')""",
    "j61_non_green_metrics":
        f"select * from ({_after_cleaning()}) a where severity not in ('GREEN', 'INFO')",
    "j61_integrity_failures":
        f"select * from ({_checks(INTEGRITY, id_column=False)}) i where status <> 'PASS'",
    "j62_stage_one_checks": _metric_rows(STAGE_ONE),
    "j63_scorecard_in_order": _baseline(),
    "j63_after_cleaning_in_order": _after_cleaning(),
    "j63_top_genres": f"{KPIS} order by weighted_installs_count desc, genre_name limit 10",
    "j64_by_category": _measures_by("category_name"),
    "j65_by_app_type": _measures_by("app_type_name"),
    "j66_by_content_rating": _measures_by("content_rating_name"),
    "j67_over_time": f"""
select year, quarter, month, count(*) as snapshot_count, {_mean('rating')} as avg_rating,
  {_mean('reviews_count')} as avg_reviews, {_mean('installs_count')} as avg_installs
from star group by rollup (year, quarter, month)""",
    "k0_assertions": """
select 'line number per order' as constraint_name,
  (select count(*) from lineitem)
  - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as violations
union all select 'customer key', (select count(*) - count(distinct c_custkey) from customer)
union all select 'balance', (select count(*) from customer where c_acctbal < 0)
union all select 'customer name', (select count(*) from customer where c_name is null)
union all select 'customer orders',
  (select count(*) from customer where c_custkey not in (select o_custkey from orders))
union all select 'order customer',
  (select count(*) from orders where o_custkey not in (select c_custkey from customer))""",
    "l1_dense_key_sparse": """
select o_orderkey, sparse_id, row_number() over (order by sparse_id) as dense_id
from (select o_orderkey, o_orderkey * 2654435761 % 9007199254740881 * 1000 as sparse_id
      from orders)""",
    "k1_unique": _unique(),
    "k2_foreign_keys": _foreign(),
    "k3_checks": _check_constraints(),
    "k4_not_null": _not_null(),
}

ORACLES = {name: _sql(body) for name, body in BODIES.items()}
