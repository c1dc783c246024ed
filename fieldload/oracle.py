"""DuckDB SQL for every registered query (the correctness oracle).

The oracle sees only the driver's raw tables, so each statement starts with
the fixture reshaping of FIXTURES.md as CTEs, then states the query in plain
SQL.  It is an independent statement of the rules: no code is shared with
the Spark side except the fixed parameters below.
"""

from __future__ import annotations

import re

# Fixed parameters, equal to those of fieldload.queries.
LOOKUP_ID = "42"
RANGE = (25, 124)
RUN_TS = "2025-01-01 00:00:00"

def ts_sql(expr: str) -> str:
    """Timestamp text to UTC wall clock, independent of DuckDB's TimeZone:
    zoned text is converted, unzoned text is read as UTC."""
    return (
        f"(CASE WHEN regexp_matches({expr}, '(Z|[+-][0-9][0-9](:?[0-9][0-9])?)$') "
        f"THEN timezone('UTC', TRY_CAST({expr} AS TIMESTAMPTZ)) "
        f"ELSE TRY_CAST({expr} AS TIMESTAMP) END)"
    )


BOX_TYPE = "STRUCT(score DOUBLE, label VARCHAR, box STRUCT(xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE))"

FIXTURE_CTES = f"""
ev AS (
  SELECT event_id AS e, ts, user_id AS u, event_type, value, props,
         CASE WHEN event_id % 13 = 0 THEN NULL
              WHEN event_type = 'view' THEN 'nothing'
              ELSE event_type END AS plab
  FROM events),
images_metadata AS (
  SELECT CAST(e AS VARCHAR) AS id,
         CASE WHEN e % 401 = 0 THEN '{{bad' ELSE props END AS exif,
         ts AS taken_at,
         CASE WHEN e % 11 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS predicted_at,
         plab AS predicted_label,
         CASE WHEN e % 503 = 0 THEN NULL
              WHEN e % 7 = 0 THEN CAST([] AS {BOX_TYPE}[])
              ELSE CAST([{{'score': value / 500,
                           'label': CASE WHEN e % 997 = 0 THEN 'ghost' ELSE event_type END,
                           'box': {{'xmin': 0.1::DOUBLE, 'ymin': 0.2::DOUBLE,
                                   'xmax': 0.1::DOUBLE + CAST(e % 5 AS DOUBLE) * 0.125::DOUBLE,
                                   'ymax': 0.75::DOUBLE}}}}] AS {BOX_TYPE}[]) END AS predicted_boxes
  FROM ev WHERE e % 101 <> 0),
ev_d AS (SELECT *, CAST(ts AS DATE) AS d FROM ev),
grp AS (
  SELECT u, d, day(d) AS dy,
         CAST(u AS VARCHAR) || '-' || strftime(d, '%Y%m%d') AS id,
         list(CAST(e AS VARCHAR) ORDER BY ts, e) AS refs,
         max(CAST(e AS VARCHAR)) AS max_id, min(plab) AS lab, count(*) AS n
  FROM ev_d GROUP BY u, d),
timeseries AS (
  SELECT id,
         CASE WHEN dy = 10 THEN list_append(refs, refs[1]) ELSE refs END AS images,
         CASE WHEN u % 7 = 0 THEN NULL ELSE max_id END AS selected_image,
         CASE WHEN u % 31 = 0 AND dy = 20 THEN 'ghost' WHEN dy = 15 THEN '' ELSE lab END AS predicted_label,
         CASE WHEN dy % 3 = 1 THEN NULL WHEN dy % 3 = 2 THEN ''
              WHEN u % 29 = 0 AND dy = 9 THEN NULL ELSE coalesce(lab, 'click') END AS ground_truth_label,
         CASE WHEN dy % 3 = 0 THEN 'verified' ELSE 'pending' END AS status,
         strftime(d, '%Y-%m-%d') || 'T00:00:00Z' AS created_at,
         strftime(d, '%Y-%m-%d') || 'T12:00:00Z' AS updated_at,
         CAST(n AS DOUBLE) AS distance, CAST(n AS INTEGER) AS num_animals,
         dy % 2 = 0 AS should_export_images, false AS camera_inactive,
         CAST(NULL AS VARCHAR) AS taken_offset
  FROM grp),
own AS (SELECT u, list(id ORDER BY id) AS ids FROM grp GROUP BY u),
projects AS (
  SELECT CAST(o.u AS VARCHAR) AS id,
         CASE WHEN o.u % 17 = 0 THEN 'failed' ELSE 'done' END AS status,
         CASE o.u % 5 WHEN 0 THEN CAST(o.u AS VARCHAR)
                      WHEN 1 THEN CAST(o.u AS VARCHAR) || '_old'
                      WHEN 2 THEN ' ' || CAST(o.u AS VARCHAR) || ' '
                      WHEN 3 THEN 'x_' || CAST(o.u AS VARCHAR)
                      ELSE CAST(o.u AS VARCHAR) || '_' END AS camera_id,
         '2024-01-01T00:00:00Z' AS created_at,
         '2024-02-01T00:00:00Z' AS updated_at,
         o.u % 10 = 9 AS deleted,
         CASE WHEN o.u % 23 = 0 THEN CAST(NULL AS VARCHAR[])
              WHEN o.u % 19 = 0 THEN CAST([] AS VARCHAR[])
              WHEN o.u % 4 = 0 THEN list_append(o.ids, 'missing-' || CAST(o.u AS VARCHAR))
              WHEN o.u % 10 = 1 AND nx.u IS NOT NULL THEN list_append(o.ids, nx.ids[1])
              ELSE o.ids END AS timeseries
  FROM own o LEFT JOIN own nx ON nx.u = o.u + 1),
labels_fixed AS (
  SELECT * FROM (VALUES (1::BIGINT, 'nothing', false), (2::BIGINT, 'click', false),
                        (3::BIGINT, 'error', true), (4::BIGINT, 'purchase', false),
                        (5::BIGINT, 'signup', true), (6::BIGINT, 'view', false)) t(id, text, blur)),
label_src AS (
  SELECT DISTINCT text, parity FROM (
    SELECT event_type AS text, u % 2 AS parity FROM ev
    UNION ALL SELECT 'nothing' AS text, u % 2 AS parity FROM ev)),
labels_dim AS (
  SELECT f.id, s.text, f.blur AND s.parity = 0 AS blur
  FROM label_src s JOIN labels_fixed f ON f.text = s.text),
dict AS (SELECT text, max(id) AS id, coalesce(bool_or(blur), false) AS blur FROM labels_dim GROUP BY text),
ts_refs AS (
  SELECT id AS ts_id, selected_image, unnest(images) AS image_id,
         CAST(generate_subscripts(images, 1) AS INTEGER) AS image_index
  FROM timeseries),
ts_attr AS (
  SELECT t.id AS ts_id, t.status, t.selected_image,
         timezone('UTC', TRY_CAST(t.created_at AS TIMESTAMPTZ)) AS created_ts,
         timezone('UTC', TRY_CAST(t.updated_at AS TIMESTAMPTZ)) AS updated_ts,
         CAST(to_json({{'distance': t.distance, 'num_animals': t.num_animals,
                        'should_export_images': t.should_export_images,
                        'camera_inactive': t.camera_inactive,
                        'taken_offset': t.taken_offset}}) AS VARCHAR) AS extra,
         t.predicted_label IS NOT DISTINCT FROM 'nothing' AS hidden,
         pl.id AS predicted_species_id, gl.id AS validated_species_id,
         t.status IS NOT DISTINCT FROM 'verified' AS verified,
         (NULLIF(t.predicted_label, '') IS NOT NULL AND pl.id IS NULL)
           OR (NULLIF(t.ground_truth_label, '') IS NOT NULL AND gl.id IS NULL) AS label_error,
         t.status IS NOT DISTINCT FROM 'verified' AND NULLIF(t.ground_truth_label, '') IS NULL AS verified_blank
  FROM timeseries t
  LEFT JOIN dict pl ON pl.text = NULLIF(t.predicted_label, '')
  LEFT JOIN dict gl ON gl.text = NULLIF(t.ground_truth_label, '')),
prior_users AS (SELECT DISTINCT u FROM grp WHERE u % 2 = 0 AND u % 5 <> 3 AND u % 17 <> 0),
prior_dataset AS (
  SELECT 1000 + p.u AS id, CAST(p.u AS VARCHAR) AS ext_id,
         TRY_CAST(NULLIF(regexp_extract(regexp_replace(pr.camera_id, '^\\s+|\\s+$', '', 'g'),
                                        '^([0-9]+)(_|$)', 1), '') AS BIGINT) AS location_id
  FROM prior_users p JOIN projects pr ON pr.id = CAST(p.u AS VARCHAR)),
prior_site AS (SELECT DISTINCT location_id AS id FROM prior_dataset),
prior_timeseries AS (
  SELECT row_number() OVER (ORDER BY g.id) AS id, g.id AS ext_id, 1000 + g.u AS dataset_id
  FROM grp g JOIN prior_users p ON p.u = g.u WHERE g.dy <= 5),
prior_image AS (
  SELECT pt.id * 10000 + r.image_index AS id, pt.dataset_id, pt.id AS timeseries_id,
         r.image_id AS ext_id, r.image_index AS sequence_index, m.predicted_boxes,
         'processed/tsimages/imported/' || r.image_id AS file
  FROM prior_timeseries pt JOIN ts_refs r ON r.ts_id = pt.ext_id
  JOIN images_metadata m ON m.id = r.image_id),
prior_box0 AS (
  SELECT id AS image_id, unnest(predicted_boxes) AS bx,
         CAST(generate_subscripts(predicted_boxes, 1) AS INTEGER) AS box_index
  FROM prior_image),
prior_bbox AS (
  SELECT b.image_id * 100 + b.box_index AS id, b.image_id, d.id AS label_id
  FROM prior_box0 b LEFT JOIN dict d ON d.text = b.bx['label']),
prior_revision AS (
  SELECT pt.id AS id, pt.id AS timeseries_id, a.validated_species_id AS label_id
  FROM prior_timeseries pt JOIN ts_attr a ON a.ts_id = pt.ext_id WHERE a.verified)
"""


# Fixture files: images that are not landed; images that cannot be read and have no target yet.
EVENT = "CAST(r.image_id AS BIGINT)"
NOT_LANDED, UNREADABLE = f"{EVENT} % 89 = 0", f"{EVENT} % 97 = 0 AND {EVENT} % 83 <> 0"


def import_ctes(requested: str, single: bool = False, files: bool = False, repeats: bool = False) -> str:
    """The import rules as CTEs over ``requested`` (a query giving ``ds_id``)."""
    # One dataset after another by key: its first timeseries nobody has taken.
    attempted = (
        """SELECT ds_id, ds_key, ts_id FROM walk WHERE ts_id IS NOT NULL"""
        if single
        else "SELECT * FROM fresh"
    )
    walk = (
        """
tried AS (SELECT f.*, coalesce(e.error, false) AS error FROM fresh f LEFT JOIN ts_err e ON e.ts_id = f.ts_id),
line AS (SELECT *, row_number() OVER (ORDER BY ds_key, ds_id) AS k FROM (SELECT DISTINCT ds_id, ds_key FROM fresh)),
walk AS (
  SELECT 0::BIGINT AS k, NULL::VARCHAR AS ds_id, NULL::INTEGER AS ds_key, NULL::VARCHAR AS ts_id, CAST([] AS VARCHAR[]) AS taken
  UNION ALL
  SELECT k, ds_id, ds_key, ts_id, CASE WHEN ts_id IS NOT NULL AND NOT error THEN list_append(taken, ts_id) ELSE taken END FROM (
    SELECT l.k, l.ds_id, l.ds_key, w.taken,
           min(t.ts_id) FILTER (WHERE NOT list_contains(w.taken, t.ts_id)) AS ts_id,
           arg_min(t.error, t.ts_id) FILTER (WHERE NOT list_contains(w.taken, t.ts_id)) AS error
    FROM walk w JOIN line l ON l.k = w.k + 1 JOIN tried t ON t.ds_id = l.ds_id
    GROUP BY l.k, l.ds_id, l.ds_key, w.taken)),"""
        if single
        else ""
    )
    aborted = "x.cutoff IS NOT NULL AND fr.ds_id IS NULL" if single else "x.cutoff IS NOT NULL"
    return f"""
req AS ({requested}),
prow AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) AS rn
                 FROM projects) WHERE rn = 1),
ds AS (
  SELECT r.ds_id, TRY_CAST(r.ds_id AS INTEGER) AS ds_key, p.id IS NOT NULL AS found, p.status,
         TRY_CAST(NULLIF(regexp_extract(regexp_replace(p.camera_id, '^\\s+|\\s+$', '', 'g'),
                                        '^([0-9]+)(_|$)', 1), '') AS BIGINT) AS site_id,
         p.deleted,
         timezone('UTC', TRY_CAST(p.created_at AS TIMESTAMPTZ)) AS created_ts,
         timezone('UTC', TRY_CAST(p.updated_at AS TIMESTAMPTZ)) AS updated_ts
  FROM req r LEFT JOIN prow p ON p.id = r.ds_id),
gate AS (
  SELECT *, CASE WHEN NOT found THEN 'not_found'
                 WHEN status IS NOT DISTINCT FROM 'failed' THEN 'failed_status'
                 WHEN site_id IS NULL THEN 'bad_site'
                 WHEN ds_key IS NULL OR created_ts IS NULL OR updated_ts IS NULL THEN 'aborted'
            END AS gate
  FROM ds),
open_ds AS (SELECT ds_id, ds_key FROM gate WHERE gate IS NULL),
listed AS (
  SELECT DISTINCT ds_id, ts_id FROM (
    SELECT p.id AS ds_id, unnest(p.timeseries) AS ts_id FROM projects p
    WHERE p.id IN (SELECT ds_id FROM open_ds)) WHERE ts_id IS NOT NULL),
prior_pairs AS (
  SELECT DISTINCT TRY_CAST(d.ext_id AS INTEGER) AS ds_key, t.ext_id AS ts_id
  FROM prior_timeseries t JOIN prior_dataset d ON d.id = t.dataset_id),
known AS (SELECT DISTINCT ext_id AS ts_id FROM prior_timeseries),
cand AS (
  SELECT l.ds_id, o.ds_key, l.ts_id, k.ts_id IS NOT NULL AS in_prior,
         a.label_error OR a.created_ts IS NULL OR a.updated_ts IS NULL
           OR (a.verified_blank AND k.ts_id IS NULL) OR ({"coalesce(k.ts_id LIKE '%01', false)" if repeats else "false"}) AS bad
  FROM listed l JOIN open_ds o ON o.ds_id = l.ds_id
  JOIN ts_attr a ON a.ts_id = l.ts_id
  LEFT JOIN known k ON k.ts_id = l.ts_id
  WHERE NOT EXISTS (SELECT 1 FROM prior_pairs pp WHERE pp.ds_key = o.ds_key AND pp.ts_id = l.ts_id)),
cutoff AS (SELECT ds_id, min(ts_id) AS cutoff FROM cand WHERE bad GROUP BY ds_id),
reach AS (
  SELECT c.* FROM cand c LEFT JOIN cutoff x ON x.ds_id = c.ds_id
  WHERE x.cutoff IS NULL OR c.ts_id < x.cutoff),
fresh AS (SELECT ds_id, ds_key, ts_id FROM reach WHERE NOT in_prior),
img AS (
  SELECT r.ts_id, r.image_index, r.image_id, r.selected_image, m.predicted_boxes,
         m.exif AS metadata, m.taken_at AS captured_at,
         timezone('UTC', TRY_CAST(NULLIF(m.predicted_at, '') AS TIMESTAMPTZ)) AS classified_at,
         m.predicted_label IS NOT DISTINCT FROM 'nothing' AS hidden,
         'processed/tsimages/imported/' || r.image_id AS file,
         NOT coalesce(json_valid(m.exif), false)
           OR (NULLIF(m.predicted_at, '') IS NOT NULL
               AND TRY_CAST(NULLIF(m.predicted_at, '') AS TIMESTAMPTZ) IS NULL)
           OR m.predicted_boxes IS NULL OR {NOT_LANDED if files else "false"} AS early_error,
         early_error OR ({UNREADABLE if files else "false"}) AS image_error
  FROM ts_refs r JOIN images_metadata m ON m.id = r.image_id
  WHERE r.ts_id IN (SELECT ts_id FROM fresh)),
box0 AS (
  SELECT ts_id, image_index, image_id, classified_at, unnest(predicted_boxes) AS bx,
         CAST(generate_subscripts(predicted_boxes, 1) AS INTEGER) AS box_index
  FROM img),
box AS (
  SELECT b.ts_id, b.image_index, b.image_id, b.classified_at, b.box_index,
         b.bx IS NULL AS box_missing, b.bx['score'] AS score,
         b.bx['box']['xmin'] AS x_min, b.bx['box']['ymin'] AS y_min,
         b.bx['box']['xmax'] AS x_max, b.bx['box']['ymax'] AS y_max,
         d.id AS label_id, coalesce(d.blur, false) AS blur
  FROM box0 b LEFT JOIN dict d ON d.text = b.bx['label']),
box_err AS (
  SELECT *, box_missing OR label_id IS NULL
            OR (blur AND (x_min IS NULL OR y_min IS NULL OR x_max IS NULL OR y_max IS NULL)) AS box_error
  FROM box),
ts_err AS (
  SELECT ts_id, bool_or(err) AS error, CAST(sum(isimg) AS BIGINT) AS n_images FROM (
    SELECT ts_id, image_error AS err, 1 AS isimg FROM img
    UNION ALL SELECT ts_id, box_error AS err, 0 AS isimg FROM box_err) GROUP BY ts_id),
{walk}
attempted AS ({attempted}),
judged AS (
  SELECT a.ds_id, a.ds_key, a.ts_id, coalesce(e.error, false) AS error,
         CAST(coalesce(e.n_images, 0) AS BIGINT) AS n_images
  FROM attempted a LEFT JOIN ts_err e ON e.ts_id = a.ts_id),
committed AS (SELECT ts_id, arg_min(ds_id, ds_key) AS ds_id FROM judged WHERE NOT error GROUP BY ts_id),
n_cand AS (SELECT ds_id, count(*) AS timeseries FROM cand GROUP BY ds_id),
n_err AS (SELECT ds_id, count(*) AS errors FROM judged WHERE error GROUP BY ds_id),
n_img AS (
  SELECT c.ds_id, CAST(sum(j.n_images) AS BIGINT) AS images
  FROM committed c JOIN (SELECT DISTINCT ds_id, ts_id, n_images FROM judged) j
    ON j.ds_id = c.ds_id AND j.ts_id = c.ts_id GROUP BY c.ds_id),
n_fresh AS (SELECT ds_id, count(*) AS n FROM attempted GROUP BY ds_id),
outcome AS (
  SELECT g.ds_id,
         coalesce(g.gate, CASE WHEN coalesce(nc.timeseries, 0) = 0 THEN 'no_new_timeseries'
                               WHEN {aborted} THEN 'aborted' ELSE 'imported' END) AS outcome,
         CAST(coalesce(nc.timeseries, 0) AS BIGINT) AS timeseries,
         CAST(coalesce(ni.images, 0) AS BIGINT) AS images,
         CAST(coalesce(ne.errors, 0) AS BIGINT) AS errors
  FROM gate g LEFT JOIN n_cand nc ON nc.ds_id = g.ds_id
  LEFT JOIN cutoff x ON x.ds_id = g.ds_id
  LEFT JOIN n_err ne ON ne.ds_id = g.ds_id
  LEFT JOIN n_img ni ON ni.ds_id = g.ds_id
  LEFT JOIN n_fresh fr ON fr.ds_id = g.ds_id),
persisted AS (
  SELECT * FROM gate WHERE gate IS NULL AND ds_id IN (SELECT ds_id FROM cand)),
new_ts AS (
  SELECT a.*, c.ds_id FROM ts_attr a JOIN committed c ON c.ts_id = a.ts_id)
"""


ALL_IDS = "SELECT DISTINCT id AS ds_id FROM projects"
RANGE_IDS = f"SELECT DISTINCT id AS ds_id FROM projects WHERE CAST(id AS INTEGER) BETWEEN {RANGE[0]} AND {RANGE[1]}"

SITE_EXPR = (
    "TRY_CAST(NULLIF(regexp_extract(regexp_replace(camera_id, '^\\s+|\\s+$', '', 'g'), "
    "'^([0-9]+)(_|$)', 1), '') AS BIGINT)"
)


def _with(body: str, *extra: str) -> str:
    ctes = ",\n".join(c.strip().rstrip(",") for c in (FIXTURE_CTES, *extra))
    return f"WITH RECURSIVE {ctes}\n{body}"


def _imp(body: str, requested: str = ALL_IDS, single: bool = False, files: bool = False, repeats: bool = False) -> str:
    return _with(body, import_ctes(requested, single, files, repeats))


def _purge(body: str) -> str:
    doomed = f"""
purge_ids AS ({RANGE_IDS}),
doomed_ds AS (
  SELECT id AS dataset_id FROM prior_dataset
  WHERE TRY_CAST(ext_id AS INTEGER) IN (SELECT TRY_CAST(ds_id AS INTEGER) FROM purge_ids)),
doomed_ts AS (SELECT id FROM prior_timeseries WHERE dataset_id IN (SELECT dataset_id FROM doomed_ds)),
doomed_img AS (SELECT id FROM prior_image WHERE dataset_id IN (SELECT dataset_id FROM doomed_ds))
"""
    return _with(body, doomed)


_ZONED_TS = re.compile(r"timezone\('UTC', TRY_CAST\((.+?) AS TIMESTAMPTZ\)\)")
_BARE_TS = re.compile(r"TRY_CAST\((.+?) AS TIMESTAMPTZ\) IS NULL")


def _tz_safe(sql: str) -> str:
    """Read timestamp text the same way whatever DuckDB's TimeZone is."""
    sql = _ZONED_TS.sub(lambda m: ts_sql(m.group(1)), sql)
    return _BARE_TS.sub(lambda m: ts_sql(m.group(1)) + " IS NULL", sql)


def statements() -> dict[str, str]:
    return {name: _tz_safe(sql) for name, sql in _statements().items()}


def _statements() -> dict[str, str]:
    ts_run = f"TIMESTAMP '{RUN_TS}'"
    return {
        "point_lookup": _with(f"""
SELECT p.id, p.status, p.camera_id, p.created_at, p.updated_at, p.deleted,
       (SELECT array_to_string(list_sort(list_distinct(flatten(list(q.timeseries)))), ',')
          FROM projects q WHERE q.id = p.id) AS timeseries_list
FROM (SELECT * FROM projects WHERE id = '{LOOKUP_ID}' LIMIT 1) p"""),
        "range_select": _with(
            f"SELECT DISTINCT id FROM projects WHERE CAST(id AS INTEGER) BETWEEN {RANGE[0]} AND {RANGE[1]}"
        ),
        "resolve_site": _with(f"SELECT id, camera_id, {SITE_EXPR} AS site_id FROM projects"),
        "parse_timestamps": _with("""
SELECT id, timezone('UTC', TRY_CAST(created_at AS TIMESTAMPTZ)) AS created_ts,
       timezone('UTC', TRY_CAST(updated_at AS TIMESTAMPTZ)) AS updated_ts FROM timeseries"""),
        "exif_valid": _with("SELECT id, coalesce(json_valid(exif), false) AS exif_ok FROM images_metadata"),
        "hidden_flag": _with(
            "SELECT id, predicted_label, predicted_label IS NOT DISTINCT FROM 'nothing' AS hidden FROM images_metadata"
        ),
        "extra_json": _with("SELECT ts_id AS id, extra FROM ts_attr"),
        "label_dictionary": _with("SELECT text, id, blur FROM dict"),
        "label_lookup": _with("""
SELECT ts_id AS id, predicted_species_id, validated_species_id, label_error, hidden FROM ts_attr"""),
        "expand_images": _with("SELECT ts_id, image_index, image_id FROM ts_refs"),
        "image_metadata": _with("""
SELECT id, exif, taken_at, predicted_at, predicted_label, CAST(len(predicted_boxes) AS INTEGER) AS n_boxes FROM images_metadata"""),
        "image_join": _with("""
SELECT r.ts_id, r.image_index, r.image_id, r.selected_image, m.exif, m.taken_at, m.predicted_at, m.predicted_label
FROM ts_refs r JOIN images_metadata m ON m.id = r.image_id"""),
        "distinct_images": _with("SELECT DISTINCT image_id FROM ts_refs WHERE image_id IS NOT NULL"),
        "images_by_timeseries": _with("""
SELECT r.ts_id, count(*) AS n_images, min(r.image_index) AS first_index, max(r.image_index) AS last_index,
       arg_min(r.image_id, r.image_index) AS first_image, arg_max(r.image_id, r.image_index) AS last_image
FROM ts_refs r JOIN images_metadata m ON m.id = r.image_id GROUP BY r.ts_id"""),
        "image_dedupe": _with("SELECT id, exif, predicted_at, predicted_label FROM images_metadata"),
        "new_timeseries": _imp("SELECT ds_id, ts_id, in_prior, bad FROM cand"),
        "abort_cutoff": _imp("SELECT ds_id, cutoff FROM cutoff"),
        "single_timeseries": _imp("SELECT ds_id, ts_id FROM attempted", single=True),
        "timeseries_owner": _imp("SELECT ts_id, ds_id FROM committed"),
        "timeseries_outcome": _imp("""
SELECT j.ds_id, j.ts_id,
       CASE WHEN j.error THEN 'error' WHEN c.ds_id = j.ds_id THEN 'committed' ELSE 'present' END AS status
FROM judged j LEFT JOIN committed c ON c.ts_id = j.ts_id"""),
        "dataset_outcome": _imp("SELECT ds_id, outcome FROM outcome"),
        "import_summary": _imp("""
SELECT ds_id, outcome, timeseries, images, errors FROM outcome
WHERE timeseries > 0 AND outcome IN ('imported', 'aborted')"""),
        "range_summary": _imp(
            "SELECT count(*) AS total, CAST(coalesce(count_if(outcome IN ('not_found', 'aborted')), 0) AS BIGINT) AS failed FROM outcome",
            requested=RANGE_IDS,
        ),
        "site_insert": _imp(f"""
SELECT DISTINCT site_id AS id, {ts_run} AS created_at, {ts_run} AS last_modified_at,
       '' AS comment, CAST(4326 AS INTEGER) AS original_sr
FROM persisted WHERE site_id NOT IN (SELECT id FROM prior_site WHERE id IS NOT NULL)"""),
        "dataset_insert": _imp("""
SELECT created_ts AS created_at, updated_ts AS last_modified_at, deleted, site_id AS location_id,
       true AS locked, '' AS comment, CAST(NULL AS BIGINT) AS registration_id, ds_id AS ext_id
FROM persisted
WHERE ds_key NOT IN (SELECT TRY_CAST(ext_id AS INTEGER) FROM prior_dataset
                     WHERE TRY_CAST(ext_id AS INTEGER) IS NOT NULL)"""),
        "timeseries_insert": _imp("""
SELECT created_ts AS created_at, updated_ts AS last_modified_at, extra, hidden, '' AS comment,
       predicted_species_id, validated_species_id, ts_id AS ext_id, ds_id AS dataset_ext_id
FROM new_ts"""),
        "revision_insert": _imp("""
SELECT ts_id, updated_ts AS created_at, updated_ts AS last_modified_at, CAST(-1 AS BIGINT) AS user_id,
       '' AS comment, validated_species_id AS label_id
FROM new_ts WHERE verified"""),
        "image_insert": _imp("""
SELECT i.image_id AS uuid, i.image_id AS ext_id, c.ds_id AS dataset_ext_id, i.ts_id AS timeseries_ext_id,
       i.image_index AS sequence_index, i.hidden, i.captured_at, i.metadata, i.file, i.classified_at
FROM img i JOIN committed c ON c.ts_id = i.ts_id"""),
        "bbox_insert": _imp("""
SELECT b.ts_id AS timeseries_ext_id, b.image_id AS image_ext_id, b.image_index AS sequence_index,
       b.box_index, b.classified_at AS created_at, b.label_id, CAST(-1 AS BIGINT) AS user_id,
       b.x_min, b.x_max, b.y_min, b.y_max, b.score
FROM box_err b WHERE b.ts_id IN (SELECT ts_id FROM committed)"""),
        "selected_image": _imp("""
SELECT c.ts_id, s.selected_index FROM committed c
LEFT JOIN (SELECT ts_id, max(image_index) AS selected_index FROM img
           WHERE image_id = selected_image GROUP BY ts_id) s ON s.ts_id = c.ts_id"""),
        "key_violations": _imp("""
SELECT * FROM (
  SELECT 'timeseries' AS table_name, ext_id AS key, count(*) AS n FROM (
    SELECT ext_id FROM prior_timeseries UNION ALL SELECT ts_id FROM committed)
  WHERE ext_id IS NOT NULL GROUP BY ext_id
  UNION ALL
  SELECT 'dataset', CAST(k AS VARCHAR), count(*) FROM (
    SELECT TRY_CAST(ext_id AS INTEGER) AS k FROM prior_dataset
    UNION ALL SELECT ds_key FROM persisted
      WHERE ds_key NOT IN (SELECT TRY_CAST(ext_id AS INTEGER) FROM prior_dataset))
  WHERE k IS NOT NULL GROUP BY k
  UNION ALL
  SELECT 'site', CAST(id AS VARCHAR), count(*) FROM (
    SELECT id FROM prior_site UNION ALL
    SELECT DISTINCT site_id FROM persisted WHERE site_id NOT IN (SELECT id FROM prior_site))
  WHERE id IS NOT NULL GROUP BY id) WHERE n > 1"""),
        "surrogate_ids": _imp("""
SELECT ts_id AS ext_id,
       CAST((SELECT coalesce(max(id), 0) FROM prior_timeseries) + row_number() OVER (ORDER BY ts_id) AS BIGINT) AS id
FROM committed"""),
        "purge_dataset": _purge("""
SELECT id, ext_id FROM prior_dataset WHERE id NOT IN (SELECT dataset_id FROM doomed_ds)"""),
        "purge_timeseries": _purge("""
SELECT id, ext_id, dataset_id FROM prior_timeseries WHERE dataset_id NOT IN (SELECT dataset_id FROM doomed_ds)"""),
        "purge_revision": _purge("""
SELECT id, timeseries_id, label_id FROM prior_revision WHERE timeseries_id NOT IN (SELECT id FROM doomed_ts)"""),
        "purge_image": _purge("""
SELECT id, ext_id, dataset_id, timeseries_id, sequence_index FROM prior_image
WHERE dataset_id NOT IN (SELECT dataset_id FROM doomed_ds)"""),
        "purge_bbox": _purge("""
SELECT id, image_id, label_id FROM prior_bbox WHERE image_id NOT IN (SELECT id FROM doomed_img)"""),
        "blur_regions": _imp("""
SELECT DISTINCT b.image_id, b.box_index,
       CAST(round_even(b.x_min * s.width, 0) AS INTEGER) AS x0,
       CAST(round_even(b.y_min * s.height, 0) AS INTEGER) AS y0,
       CAST(round_even(b.x_max * s.width, 0) AS INTEGER) AS x1,
       CAST(round_even(b.y_max * s.height, 0) AS INTEGER) AS y1
FROM box_err b
JOIN (SELECT CAST(e AS VARCHAR) AS image_id, CAST(32 + 8 * (e % 4) AS DOUBLE) AS width,
             CAST(24 + 8 * (e % 3) AS DOUBLE) AS height FROM ev) s ON s.image_id = b.image_id
WHERE b.blur AND b.ts_id IN (SELECT ts_id FROM committed)"""),
        "file_state": _imp("""
SELECT i.image_id AS ext_id, i.ts_id AS timeseries_ext_id, i.image_index AS sequence_index, i.file,
       CAST(i.image_id AS BIGINT) % 83 = 0 AND CAST(i.image_id AS BIGINT) % 89 <> 0 AS target_exists
FROM img i JOIN committed c ON c.ts_id = i.ts_id""", files=True),
        "import_files": _imp("SELECT ds_id, outcome, timeseries, images, errors FROM outcome", files=True),
        "repeated_prior": _imp("SELECT ds_id, outcome, timeseries, images, errors FROM outcome", repeats=True),
        "stored_files": _imp("""
SELECT 'processed/tsimages/imported/' || e AS path FROM ev WHERE e % 83 = 0 AND e % 89 <> 0
UNION
SELECT file FROM img WHERE CAST(image_id AS BIGINT) % 97 <> 0
  AND ts_id NOT IN (SELECT ts_id FROM img WHERE early_error UNION SELECT ts_id FROM box_err WHERE box_error)""", files=True),
        "redact_images": _imp("""
SELECT s.image_id, s.height, s.width, CAST(count(DISTINCT b.box_index) AS INTEGER) AS n_regions, true AS outside_same
FROM (SELECT DISTINCT i.image_id FROM img i JOIN committed c ON c.ts_id = i.ts_id WHERE CAST(i.image_id AS BIGINT) % 83 <> 0) m
JOIN (SELECT CAST(e AS VARCHAR) AS image_id, CAST(32 + 8 * (e % 4) AS INTEGER) AS width,
             CAST(24 + 8 * (e % 3) AS INTEGER) AS height FROM ev) s ON s.image_id = m.image_id
LEFT JOIN (SELECT * FROM box_err WHERE blur AND ts_id IN (SELECT ts_id FROM committed)) b ON b.image_id = m.image_id
GROUP BY ALL""", files=True),
        "ordered_images": _with("""
SELECT r.ts_id, r.image_index, r.image_id FROM ts_refs r JOIN images_metadata m ON m.id = r.image_id"""),
        "timestamp_forms": _with("""
SELECT e AS event_id, e % 16 AS form, CAST(CASE e % 16
  WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('day', ts) WHEN 2 THEN date_trunc('day', ts)
  WHEN 3 THEN CASE WHEN day(ts) <= 12 THEN make_timestamp(year(ts), day(ts), month(ts), 0, 0, 0) ELSE date_trunc('day', ts) END
  WHEN 4 THEN date_trunc('minute', ts) WHEN 5 THEN date_trunc('day', ts) WHEN 6 THEN date_trunc('day', ts)
  WHEN 7 THEN date_trunc('second', ts) WHEN 8 THEN date_trunc('second', ts) WHEN 9 THEN date_trunc('second', ts)
  WHEN 10 THEN date_trunc('minute', ts) WHEN 15 THEN date_trunc('day', ts) END AS TIMESTAMP) AS parsed FROM ev"""),
        "json_forms": _with("""
SELECT e AS event_id, e % 8 AS form, CASE WHEN e % 8 = 0 THEN coalesce(json_valid(props), false) ELSE e % 8 < 5 END AS valid FROM ev"""),
        "key_repeats": _with("""
SELECT 'dataset' AS table_name, CAST(u AS VARCHAR) AS key, count(*) AS n
FROM (SELECT u, unnest(CASE u % 3 WHEN 0 THEN [1, 2] WHEN 1 THEN [1, 2] ELSE [1] END) AS x FROM (SELECT DISTINCT u FROM ev))
GROUP BY u HAVING count(*) > 1
UNION ALL
SELECT 'pair', '["' || u || '","' || event_type || '"]', count(*) FROM ev GROUP BY u, event_type HAVING count(*) > 1"""),
        "overlap_boxes": _with("""
SELECT image_id, box_index, d.id AS label_id, coalesce(d.blur, false) AS blur,
  missing OR d.id IS NULL OR (coalesce(d.blur, false) AND (x_min IS NULL OR x_max IS NULL)) AS box_error, x_min, x_max
FROM (
  SELECT CAST(e AS VARCHAR) AS image_id, 1 AS box_index, false AS missing,
    CASE WHEN e % 10 = 0 THEN 'ghost' WHEN e % 21 = 0 THEN NULL ELSE event_type END AS label,
    CASE WHEN e % 6 <> 0 THEN 0.25::DOUBLE END AS x_min, 0.75::DOUBLE AS x_max FROM ev
  UNION ALL
  SELECT CAST(e AS VARCHAR), 2, e % 15 = 0, CASE WHEN e % 15 <> 0 THEN 'error' END,
    CASE WHEN e % 15 <> 0 THEN 0.5::DOUBLE END, CASE WHEN e % 15 <> 0 AND e % 4 <> 0 THEN 0.25::DOUBLE END FROM ev) b
LEFT JOIN dict d ON d.text = b.label"""),
        "image_repeats": _with("""
SELECT id, arg_max(props, p) AS exif, max(p) AS predicted_at, (arg_max({'l': plab}, p)).l AS predicted_label
FROM (SELECT CAST(e // 3 AS VARCHAR) AS id, props, plab, lpad(CAST(e * 7919 % 1000003 AS VARCHAR), 12, '0') AS p FROM ev) GROUP BY id"""),
    }
