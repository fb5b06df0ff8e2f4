"""The queries of ``workload.queries`` as DuckDB SQL over the same tables."""

from __future__ import annotations

WIDTH = 64
FEATURES = [f"f_{i + 1}" for i in range(WIDTH)]


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0.0::DOUBLE"


def with_tables(*names: str, body: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({TABLES[n]})" for n in names) + "\n" + body


def _well(row: str, col: str) -> str:
    return f"chr((65 + {row})::INT) || lpad(({col} + 1)::VARCHAR, 2, '0')"


LI_WELL = _well("l_suppkey % 8", "l_partkey % 12")
O_WELL = _well("(o_custkey % 96) // 24", "(o_custkey % 24) // 2")
C_WELL = _well("(c_custkey % 96) // 24", "(c_custkey % 24) // 2")

_NAMES = {1: "DNA", 2: "Mito", 3: "AGP", 4: "RNA", 5: "ER"}
_INDEX_CHANNELS = ["DNA", "RNA", "ER", "AGP", "Mito"]
_NUMBER = {name: n for n, name in _NAMES.items()}
_COMPOUND = "CASE WHEN label = 0 THEN 'DMSO' ELSE 'HY-' || lpad(label::VARCHAR, 3, '0') END"

TABLES = {
    "cells": f"""
        SELECT l_returnflag AS "Metadata_Plate", {LI_WELL} AS "Metadata_Well", l_orderkey AS cell,
               l_quantity AS "Cells_Quantity", l_extendedprice AS "Nuclei_Price",
               l_discount AS "Cytoplasm_Discount"
        FROM lineitem""",
    "counts": """
        SELECT "Metadata_Plate" AS plate, "Metadata_Well" AS well, count(*) AS value
        FROM cells GROUP BY ALL""",
    "placed": """
        SELECT *, ascii(well) - 65 AS r, substr(well, 2)::BIGINT - 1 AS c FROM counts""",
    "shape": """
        SELECT CASE WHEN max(r) < 8 AND max(c) < 12 THEN 8 WHEN max(r) < 16 AND max(c) < 24 THEN 16
                    WHEN max(r) < 32 AND max(c) < 48 THEN 32 ELSE max(r) + 1 END::BIGINT AS n_rows,
               CASE WHEN max(r) < 8 AND max(c) < 12 THEN 12 WHEN max(r) < 16 AND max(c) < 24 THEN 24
                    WHEN max(r) < 32 AND max(c) < 48 THEN 48 ELSE max(c) + 1 END::BIGINT AS n_cols
        FROM placed""",
    "labelled": """
        SELECT plate, CASE WHEN kind = 4 THEN '?' || l_linenumber WHEN l_partkey % 211 = 0 THEN 'ZZ99'
                 WHEN l_partkey % 223 = 0 THEN 'empty' WHEN l_partkey % 227 = 0 THEN NULL
                 ELSE CASE WHEN r < 26 THEN chr((r + 65)::INT) ELSE 'A' || chr((r + 39)::INT) END
                   || lpad((c + 1)::VARCHAR, 2, '0') END AS well, count(*) AS value
        FROM (SELECT *, 'F' || kind AS plate, l_partkey % [8, 16, 32, 44, 44][kind + 1] AS r,
                (l_suppkey * 7 + l_linenumber * 5 + l_orderkey) % [12, 24, 48, 60, 60][kind + 1] AS c
              FROM (SELECT *, l_orderkey % 5 AS kind FROM lineitem))
        GROUP BY ALL""",
    "parsed": """
        SELECT *, CASE WHEN length(a) = 1 THEN ascii(a) - 65 WHEN length(a) = 2
                    THEN (ascii(a[1]) - 64) * 26 + ascii(a[2]) - 65 END AS r, try_cast(d AS BIGINT) - 1 AS c
        FROM (SELECT *, regexp_extract(well, '^([A-Z]+)([0-9]+)$', 1) AS a,
                     regexp_extract(well, '^([A-Z]+)([0-9]+)$', 2) AS d FROM labelled)""",
    "sized": """
        SELECT plate, CASE WHEN o96 <= o THEN 8 WHEN o384 <= o THEN 16 WHEN o1536 <= o THEN 32 ELSE rows END::BIGINT AS n_rows,
          CASE WHEN o96 <= o THEN 12 WHEN o384 <= o THEN 24 WHEN o1536 <= o THEN 48 ELSE cols END::BIGINT AS n_cols,
          CASE WHEN o96 <= o THEN o96 WHEN o384 <= o THEN o384 WHEN o1536 <= o THEN o1536 ELSE 0 END AS beyond,
          coalesce(n, 0) AS positions
        FROM (SELECT DISTINCT plate FROM labelled) LEFT JOIN (
          SELECT plate, count(*) AS n, floor(0.02 * count(*)) AS o, max(r) + 1 AS rows, max(c) + 1 AS cols,
            count(*) FILTER (r >= 8 OR c >= 12) AS o96, count(*) FILTER (r >= 16 OR c >= 24) AS o384,
            count(*) FILTER (r >= 32 OR c >= 48) AS o1536
          FROM (SELECT DISTINCT plate, r, c FROM parsed WHERE r IS NOT NULL AND c IS NOT NULL) GROUP BY plate) USING (plate)""",
    "files": f"""
        SELECT l_returnflag AS "Metadata_Plate",
               'TimePoint_' || round(l_tax * 100)::INT || '/' || name AS path, name AS "FileName"
        FROM (SELECT *, CASE WHEN l_quantity = 1 THEN 'notes' ELSE '2025-W51_' END || {LI_WELL}
                  || '_s' || (l_orderkey % 40 + 1) || '_w' || l_linenumber
                  || CASE WHEN l_discount = 0 THEN '_Thumb' ELSE '' END || '_' || l_orderkey || '.tif'
                  AS name
              FROM lineitem)""",
    "images": """
        SELECT "Metadata_Plate", path, "FileName",
               regexp_extract("FileName", pattern, 1) AS "Well",
               try_cast(regexp_extract("FileName", pattern, 2) AS INT) AS "Site",
               try_cast(regexp_extract("FileName", pattern, 3) AS INT) AS "ChannelNumber"
        FROM files, (SELECT '^[^_]+_([A-P][0-9]{2})_s([0-9]{1,2})_w([0-9])' AS pattern)
        WHERE NOT contains(lower("FileName"), '_thumb') AND regexp_matches("FileName", pattern)
          AND regexp_extract("FileName", pattern, 3) IN ('1', '2', '3', '4', '5')""",
    "sets": """
        SELECT "Metadata_Plate", "Well" AS "Metadata_Well", "Site" AS "Metadata_Site", """
    + ", ".join(
        f"""arg_max("FileName", string_split(path, '/')) FILTER (WHERE "ChannelNumber" = {n})
            AS "Image_FileName_Orig{name}" """
        for n, name in _NAMES.items()
    )
    + " FROM images GROUP BY ALL",
    "chunked": """
        SELECT *, (row_number() OVER (PARTITION BY "Metadata_Plate"
                   ORDER BY "Metadata_Well", "Metadata_Site") - 1) // 100 + 1 AS chunk
        FROM sets""",
    "manifest": """
        SELECT DISTINCT "Metadata_Plate", chunk, "FileName" FROM (
        SELECT "Metadata_Plate", chunk, unnest(["""
    + ", ".join(f'"Image_FileName_Orig{n}"' for n in _NAMES.values())
    + """]) AS "FileName" FROM chunked) WHERE "FileName" IS NOT NULL""",
    "image_table": f"""
        SELECT 'P' || (o_custkey // 96) AS "Metadata_Plate", {O_WELL} AS "Metadata_Well",
               CASE WHEN o_orderkey % 9 = 0 THEN 'edge' ELSE (o_orderkey % 50)::VARCHAR END
                   AS "Metadata_Site", """
    + ", ".join(
        f"""{O_WELL} || '.w{n}.' || o_orderkey || '.tif' AS "FileName_Orig{name}" """
        for n, name in _NAMES.items()
    )
    + " FROM orders",
    "site_index": """
        SELECT "Metadata_Plate", "Metadata_Well", "Metadata_Site", """
    + ", ".join(
        f""""Metadata_Plate" || '/' || regexp_replace("FileName_Orig{name}", '\\.[^.]*$', '')
            || '.tiff' AS "{name}" """
        for name in _INDEX_CHANNELS
    )
    + " FROM image_table",
    "plate_map": f"""
        SELECT 'P' || (c_custkey // 96) AS map_plate, {C_WELL} AS map_well,
               c_mktsegment AS "Metadata_Compound", c_nationkey::VARCHAR AS "Metadata_Batch"
        FROM customer WHERE c_acctbal > 0""",
    "whole_plate_map": f"""
        SELECT 'P' || (c_custkey // 96) AS map_plate, {C_WELL} AS map_well,
               c_mktsegment AS "Metadata_Compound", c_nationkey::VARCHAR AS "Metadata_Batch"
        FROM customer""",
    "locations": f"""
        SELECT l_returnflag AS "Metadata_Plate", {LI_WELL} AS "Metadata_Well",
               (l_orderkey % 4 + 1)::VARCHAR AS "Metadata_Site",
               round_even(l_quantity / 2, 0)::BIGINT AS "Nuclei_Location_Center_X",
               round_even(l_extendedprice, 0)::BIGINT AS "Nuclei_Location_Center_Y"
        FROM lineitem""",
    "sources": """
        SELECT 'src' || (l_suppkey % 5) AS source,
               count(*) FILTER (WHERE l_linestatus = 'F' AND l_suppkey % 5 <> 3) > 0 AS complete
        FROM lineitem GROUP BY ALL""",
    "profiles": f"SELECT vec_id, {_COMPOUND} AS compound, embedding::DOUBLE[] AS v FROM embeddings",
    "dirty": """
        SELECT vec_id, CASE WHEN vec_id % 7 <> 0 THEN v[1] END AS f_1,
               CASE WHEN vec_id % 5 > 1 THEN v[2] END AS f_2,
               CASE WHEN vec_id % 3 = 0 THEN v[5] END AS f_5, """
    + ", ".join(f"v[{i}] AS f_{i}" for i in range(6, WIDTH + 1))
    + " FROM profiles",
    "clean": """
        SELECT vec_id, """
    + ", ".join(
        f"coalesce({f}, (SELECT median({f}) FROM dirty)) AS {f}"
        if f in ("f_1", "f_2", "f_5")
        else f
        for f in FEATURES
        if f not in ("f_3", "f_4")
    )
    + " FROM dirty",
    "long": """
        SELECT vec_id, compound, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM profiles""",
    "correlated": """
        SELECT a.vec_id AS "left", b.vec_id AS "right", corr(a.x, b.x) AS r
        FROM long a JOIN long b ON a.i = b.i AND a.vec_id <> b.vec_id GROUP BY ALL""",
    "pairs": """
        SELECT a.compound, corr(a.x, b.x) AS r
        FROM long a JOIN long b ON a.compound = b.compound AND a.i = b.i AND a.vec_id < b.vec_id
        WHERE a.compound <> 'DMSO' GROUP BY a.compound, a.vec_id, b.vec_id""",
    "scores": "SELECT compound, median(r) AS score FROM pairs GROUP BY compound",
    "numbered": "SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS number FROM profiles",
    "draws": """
        SELECT draw, (l * l % 2147483647) * 69621 % 2147483647 % n AS a,
               (r * r % 2147483647) * 16807 % 2147483647 % n AS b
        FROM (SELECT draw, (draw + 1) * 48271 % 2147483647 AS l,
                     (draw + 1) * 39373 % 2147483647 AS r
              FROM (SELECT unnest(range(5000)) AS draw)),
             (SELECT count(*) AS n FROM profiles)""",
    "null_pairs": """
        SELECT draw, corr(x, y) AS r
        FROM (SELECT draw, unnest(p.v) AS x, unnest(q.v) AS y
              FROM draws JOIN numbered p ON p.number = a JOIN numbered q ON q.number = b
              WHERE p.compound <> q.compound)
        GROUP BY draw""",
    "threshold": "SELECT quantile_cont(r, 0.95) AS threshold FROM null_pairs",
    "series": """
        SELECT 'null' AS series, r AS value FROM null_pairs
        UNION ALL SELECT 'replicate', score FROM scores""",
    "active": """
        SELECT vec_id, compound, CASE WHEN compound = 'DMSO' THEN '-inf'::DOUBLE
                                      ELSE sqrt(sum((x - m) ^ 2)) END AS activity
        FROM long JOIN (SELECT i, avg(x) AS m FROM long WHERE compound = 'DMSO' GROUP BY i) USING (i)
        GROUP BY vec_id, compound""",
    "top": "SELECT * FROM active ORDER BY activity DESC, vec_id LIMIT 50",
}

_CLEAN = [f for f in FEATURES if f not in ("f_3", "f_4")]
_MEDIANS = [
    f'{r6(f"median({c})")} AS {c}'
    for c in ('"Cells_Quantity"', '"Nuclei_Price"', '"Cytoplasm_Discount"')
]
_PARTS = {
    "O": "o_custkey::INT AS o_custkey",
    "F": "o_custkey",
    "P": "o_custkey",
}
# The leading axis is what the powers of the covariance turn to: 18 squarings, each scaled.
_PLANE = f"""
, moments AS (
  SELECT i, avg(x) AS m, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS s
  FROM (SELECT unnest(range(1, {WIDTH + 1})) AS i, unnest(v) AS x FROM profiles) GROUP BY i),
kept AS (SELECT list(m ORDER BY i) AS m, list(s ORDER BY i) AS s FROM moments),
scaled AS (
  SELECT vec_id, compound, [(v[i] - m[i]) / s[i] for i in range(1, {WIDTH + 1})] AS z FROM profiles, kept),
cells AS (
  SELECT i, j, sum(z[i] * z[j]) AS c
  FROM scaled, (SELECT unnest(range(1, {WIDTH + 1})) AS i), (SELECT unnest(range(1, {WIDTH + 1})) AS j) GROUP BY i, j),
matrix AS (SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(c ORDER BY j) AS r FROM cells GROUP BY i)),
first_power AS (
  SELECT 0 AS step, c AS p FROM matrix
  UNION ALL
  SELECT step + 1, [[list_inner_product(a, b) / norm for b in p] for a in p]
  FROM (SELECT step, p, list_sum([list_inner_product(a, a) for a in p]) AS norm FROM first_power) WHERE step < 18),
first_axis AS (
  SELECT [x / sqrt(list_inner_product(a, a)) for x in a] AS a
  FROM (SELECT p[list_position([list_inner_product(a, a) for a in p], list_max([list_inner_product(a, a) for a in p]))] AS a
        FROM first_power WHERE step = 18)),
rest AS (
  SELECT [[c[i][j] - w * a[i] * a[j] for j in range(1, {WIDTH + 1})] for i in range(1, {WIDTH + 1})] AS c
  FROM (SELECT c, a, list_inner_product(a, [list_inner_product(r, a) for r in c]) AS w FROM matrix, first_axis)),
second_power AS (
  SELECT 0 AS step, c AS p FROM rest
  UNION ALL
  SELECT step + 1, [[list_inner_product(a, b) / norm for b in p] for a in p]
  FROM (SELECT step, p, list_sum([list_inner_product(a, a) for a in p]) AS norm FROM second_power) WHERE step < 18),
second_axis AS (
  SELECT [x / sqrt(list_inner_product(a, a)) for x in a] AS a
  FROM (SELECT p[list_position([list_inner_product(a, a) for a in p], list_max([list_inner_product(a, a) for a in p]))] AS a
        FROM second_power WHERE step = 18)),
signed AS (
  SELECT n, [x * CASE WHEN a[list_position(size, list_max(size))] >= 0 THEN 1 ELSE -1 END for x in a] AS a
  FROM (SELECT n, a, [round(abs(x), 9) for x in a] AS size
        FROM (SELECT 1 AS n, a FROM first_axis UNION ALL SELECT 2, a FROM second_axis)))
SELECT vec_id, compound AS "Metadata_Compound",
       {r6("list_inner_product(z, (SELECT a FROM signed WHERE n = 1))")} AS component_1,
       {r6("list_inner_product(z, (SELECT a FROM signed WHERE n = 2))")} AS component_2
FROM scaled
"""
_COHORT_NULL = ["profiles", "numbered", "draws", "null_pairs"]


def all_sql() -> dict[str, str]:
    sets = ["cells", "counts", "placed"]
    images = ["files", "images"]
    sql = {
        "a1_grouped_median": with_tables(
            "cells",
            body=f"""SELECT "Metadata_Plate", "Metadata_Well", {', '.join(_MEDIANS)}
            FROM cells GROUP BY ALL""",
        ),
        "a1_median_nan_skip": with_tables(
            "cells",
            body=f"""SELECT "Metadata_Well",
            {r6('median(CASE WHEN cell % 7 <> 0 THEN "Nuclei_Price" END)')} AS "Nuclei_Price"
            FROM cells GROUP BY ALL""",
        ),
        "a1_median_null_group": with_tables(
            "cells",
            body=f"""SELECT nullif("Metadata_Plate", 'N') AS "Metadata_Plate",
            {_MEDIANS[1]}, {_MEDIANS[0]} FROM cells GROUP BY 1""",
        ),
        "a1_median_hot_groups": with_tables(
            "cells",
            body=f"""SELECT "Metadata_Plate", {_MEDIANS[1]}, {_MEDIANS[0]}
            FROM cells GROUP BY ALL""",
        ),
        "a1_median_near_constant": with_tables(
            "cells",
            body="""SELECT "Metadata_Plate",
            round((median(1000.0::DOUBLE + (cell % 5) * 1.2e-13::DOUBLE) - 1000.0) * 1e13::DOUBLE, 3) AS "Cells_Near",
            round(median((cell % 4) * 1e-310::DOUBLE) * 1e300::DOUBLE * 1e10::DOUBLE, 3) AS "Cells_Tiny",
            median(CASE WHEN cell % 5 = 0 THEN '-inf'::DOUBLE WHEN cell % 5 < 3 THEN 'inf'::DOUBLE
                   ELSE "Nuclei_Price" END) AS "Cells_Ends"
            FROM cells GROUP BY ALL""",
        ),
        "p1_infer_features_median": with_tables(
            "cells", body=f'SELECT "Metadata_Well", {", ".join(_MEDIANS)} FROM cells GROUP BY ALL'
        ),
        "a1_median_wide": with_tables(
            "profiles",
            body='SELECT compound AS "Metadata_Compound", '
            + ", ".join(f"{r6(f'median(v[{i}])')} AS f_{i}" for i in range(1, WIDTH + 1))
            + ", "
            + ", ".join(f"{r6(f'median(-v[{i}])')} AS g_{i}" for i in range(1, WIDTH + 1))
            + " FROM profiles GROUP BY ALL",
        ),
        "a2_cells_per_well": with_tables(
            "cells", body='SELECT "Metadata_Well" AS well, count(*) AS value FROM cells GROUP BY ALL'
        ),
        "a7_mean_abs_feature": with_tables(
            "profiles",
            "long",
            body=f"SELECT vec_id, {r6('avg(abs(x))')} AS value FROM long GROUP BY vec_id",
        ),
        "a8_pooled_p99": with_tables(
            "cells",
            "counts",
            body=f"""SELECT CASE WHEN q = 0 THEN 1.0 ELSE {r6('q')} END AS value_max
            FROM (SELECT quantile_cont(value::DOUBLE, 0.99) AS q FROM counts)""",
        ),
        "f1_parse_wells": f"""
            SELECT DISTINCT well,
              CASE WHEN letters <> '' THEN list_sum(list_transform(range(1, length(letters) + 1),
                lambda k: (ascii(upper(letters[k])) - 64) * (26 ** (length(letters) - k))::BIGINT
              ))::BIGINT - 1 END AS row,
              try_cast(nullif(digits, '') AS BIGINT) - 1 AS col
            FROM (SELECT well, regexp_extract(well, pattern, 1) AS letters,
                         regexp_extract(well, pattern, 2) AS digits
              FROM (SELECT '^\\s*([A-Za-z]+)\\s*0*([0-9]+)\\s*$' AS pattern,
                CASE l_linenumber WHEN 1 THEN lower(well) WHEN 2 THEN ' ' || well || ' '
                  WHEN 3 THEN chr((l_partkey % 26 + 65)::INT) || well WHEN 4 THEN well || 'x'
                  WHEN 5 THEN '' ELSE well END AS well
                FROM (SELECT *, {LI_WELL} AS well FROM lineitem)))""",
        "f2_row_letters": """
            SELECT p_partkey, letters, list_sum(list_transform(range(1, length(letters) + 1),
                lambda k: (ascii(upper(letters[k])) - 64) * (26 ** (length(letters) - k))::BIGINT
              ))::BIGINT - 1 AS row
            FROM (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN b || a || b
                         WHEN p_size % 3 = 0 THEN a ELSE a || b END AS letters
              FROM (SELECT *, chr((p_partkey % 26 + 97)::INT) AS a,
                              chr((p_size % 26 + 65)::INT) AS b FROM part))""",
        "a9_grid_shape": with_tables(*sets, "shape", body="SELECT * FROM shape"),
        "j7_plate_grid": with_tables(
            *sets,
            "shape",
            body="""SELECT plate, g.row, h.col, value
            FROM (SELECT DISTINCT plate FROM placed),
              (SELECT unnest(range((SELECT n_rows FROM shape))) AS row) g,
              (SELECT unnest(range((SELECT n_cols FROM shape))) AS col) h
            LEFT JOIN (SELECT plate AS p, r, c, arg_max(value, well) AS value FROM placed GROUP BY ALL)
              ON p = plate AND r = g.row AND c = h.col""",
        ),
        "a9_plate_shapes": with_tables("labelled", "parsed", "sized", body="SELECT * FROM sized"),
        "p18_outlying_wells": with_tables(
            "labelled",
            "parsed",
            "sized",
            body="""SELECT plate, well, CASE WHEN r IS NULL OR c IS NULL THEN 'no well' ELSE 'beyond the plate' END AS reason
            FROM parsed JOIN sized USING (plate) WHERE r IS NULL OR c IS NULL OR r >= n_rows OR c >= n_cols""",
        ),
        "j7_plate_grids": with_tables(
            "labelled",
            "parsed",
            "sized",
            body="""SELECT g.plate, g.row, g.col, value
            FROM (SELECT plate, row, unnest(range(n_cols)) AS col
                  FROM (SELECT plate, n_cols, unnest(range(n_rows)) AS row FROM sized)) g
            LEFT JOIN (SELECT plate, r, c, arg_max(value, well) AS value FROM parsed GROUP BY ALL) v
              ON v.plate = g.plate AND v.r = g.row AND v.c = g.col""",
        ),
        "p7_parse_image_names": with_tables(
            *images,
            body="""SELECT *, ['DNA', 'Mito', 'AGP', 'RNA', 'ER']["ChannelNumber"] AS "Channel"
            FROM images""",
        ),
        "a3_pivot_channels": with_tables(
            *images,
            "sets",
            body="SELECT *, "
            + ", ".join(
                f"""'images' AS "Image_PathName_Orig{n}", 'Illum{n}.npy' AS "Image_FileName_Illum{n}",
                'illum' AS "Image_PathName_Illum{n}" """
                for n in _NAMES.values()
            )
            + " FROM sets",
        ),
        "a4_incomplete_sets": with_tables(
            *images,
            body="""SELECT "Metadata_Plate", "Well" AS "Metadata_Well", "Site" AS "Metadata_Site",
            concat_ws(', ', """
            + ", ".join(
                f"""CASE WHEN NOT bool_or("ChannelNumber" = {n}) THEN 'w{n}' END""" for n in _NAMES
            )
            + """) AS missing FROM images GROUP BY 1, 2, 3
            HAVING count(DISTINCT "ChannelNumber") < 5""",
        ),
        "w1_chunk_number": with_tables(
            *images,
            "sets",
            "chunked",
            body='SELECT "Metadata_Plate", "Metadata_Well", "Metadata_Site", chunk FROM chunked',
        ),
        "a15_chunk_manifest": with_tables(
            *images, "sets", "chunked", "manifest", body="SELECT * FROM manifest"
        ),
        "p12_index_paths": with_tables("image_table", "site_index", body="SELECT * FROM site_index"),
        "p11_round_locations": with_tables("locations", body="SELECT * FROM locations"),
        "j1_platemap_left_join": with_tables(
            "image_table",
            "site_index",
            "plate_map",
            body="""SELECT "Metadata_Plate", "Metadata_Well", "Metadata_Site", "DNA",
              "Metadata_Compound", "Metadata_Batch"
            FROM site_index LEFT JOIN plate_map
              ON map_plate = "Metadata_Plate" AND map_well = "Metadata_Well" """,
        ),
        "j2_unmatched_keys": with_tables(
            "image_table",
            "site_index",
            "plate_map",
            body="""SELECT DISTINCT "Metadata_Plate" || '/' || "Metadata_Well" AS key FROM site_index
            WHERE NOT EXISTS (SELECT 1 FROM plate_map
              WHERE map_plate = "Metadata_Plate" AND map_well = "Metadata_Well")""",
        ),
        "j3_compartment_join": with_tables(
            "sources",
            body=f"""SELECT source, l_suppkey AS "Metadata_ImageNumber",
              'P' || s_nationkey AS "Metadata_Plate",
              {_well("s_suppkey % 8", "s_suppkey % 12")} AS "Metadata_Well",
              l_partkey AS "Cytoplasm_Parent_Cells", l_orderkey AS "Cytoplasm_Parent_Nuclei",
              l_orderkey * 8 + l_linenumber AS "Cytoplasm_ObjectNumber",
              l_discount AS "Cytoplasm_Texture", area AS "Cells_Area",
              intensity AS "Nuclei_Intensity"
            FROM (SELECT *, 'src' || (l_suppkey % 5) AS source FROM lineitem)
            JOIN sources USING (source)
            LEFT JOIN supplier ON s_suppkey = l_suppkey
            LEFT JOIN (SELECT l_suppkey, l_partkey, max(l_quantity) AS area
                       FROM lineitem GROUP BY ALL) USING (l_suppkey, l_partkey)
            LEFT JOIN (SELECT l_suppkey, l_orderkey, max(l_extendedprice) AS intensity
                       FROM lineitem WHERE l_linestatus = 'F' AND l_suppkey % 5 <> 3 GROUP BY ALL)
              USING (l_suppkey, l_orderkey)
            WHERE complete""",
        ),
        "a6_skip_empty_sources": with_tables("sources", body="SELECT * FROM sources"),
        "p5_cast_float": with_tables(
            "cells",
            body="""SELECT "Metadata_Plate", "Metadata_Well", max(cell::DOUBLE) AS "Metadata_Cell",
            max("Cells_Quantity"::FLOAT)::DOUBLE AS "Cells_Quantity",
            max("Nuclei_Price"::FLOAT)::DOUBLE AS "Nuclei_Price",
            max("Cytoplasm_Discount"::FLOAT)::DOUBLE AS "Cytoplasm_Discount"
            FROM cells GROUP BY 1, 2""".replace(
                'max(cell::DOUBLE) AS "Metadata_Cell",\n', ""
            ),
        ),
        "u1_strict_union": """SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey, o_totalprice,
            o_orderstatus FROM orders""",
        "u2_loose_union": """
            SELECT o_orderkey, o_custkey::VARCHAR AS o_custkey,
              CASE WHEN o_orderstatus <> 'O' THEN o_totalprice END AS o_totalprice,
              CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS o_orderstatus
            FROM orders""",
        "p14_clean_features": with_tables(
            "profiles",
            "dirty",
            "clean",
            body="SELECT vec_id, " + ", ".join(f"{r6(f)} AS {f}" for f in _CLEAN) + " FROM clean",
        ),
        "a16_standardise": with_tables(
            "profiles",
            "dirty",
            "clean",
            body="SELECT vec_id, "
            + ", ".join(
                f"{r6(f'({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER ()')} AS {f}"
                for f in _CLEAN
            )
            + " FROM clean",
        ),
        "a10_row_zscores": with_tables(
            "profiles",
            "long",
            body=f"""SELECT vec_id, (i - 1)::INT AS position, {r6('(x - m) / s')} AS z FROM long
            JOIN (SELECT vec_id, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY vec_id)
              USING (vec_id) WHERE s > 0""",
        ),
        "p19_flat_rows": with_tables(
            "profiles",
            "long",
            body=f"""SELECT vec_id, (i - 1)::INT AS position, {r6('(x - m) / s')} AS z FROM long
            JOIN (SELECT vec_id, avg(x) AS m, stddev_pop(x) AS s FROM long GROUP BY vec_id)
              USING (vec_id) WHERE s > 0 AND vec_id % 10 <> 3""",
        ),
        "a11_replicate_score": with_tables(
            "profiles",
            "long",
            "pairs",
            "scores",
            body=f'SELECT compound AS "Metadata_Compound", {r6("score")} AS score FROM scores',
        ),
        "j5_null_pairs": with_tables(
            *_COHORT_NULL, body=f"SELECT draw, {r6('r')} AS r FROM null_pairs"
        ),
        "a12_null_threshold": with_tables(
            *_COHORT_NULL, "threshold", body=f"SELECT {r6('threshold')} AS threshold FROM threshold"
        ),
        "a12_null_threshold_all": with_tables(
            "profiles",
            "long",
            body=f"""SELECT {r6('quantile_cont(r, 0.95)')} AS threshold FROM (
              SELECT corr(a.x, b.x) AS r FROM long a JOIN long b ON a.i = b.i AND a.vec_id < b.vec_id
              WHERE a.compound IS DISTINCT FROM b.compound GROUP BY a.vec_id, b.vec_id)""",
        ),
        "a13_percent_replicating": with_tables(
            *_COHORT_NULL,
            "threshold",
            "long",
            "pairs",
            "scores",
            body=f"""SELECT {r6('100 * avg((score > threshold)::INT)')} AS percent_replicating
            FROM scores, threshold""",
        ),
        "a14_histogram": with_tables(
            *_COHORT_NULL,
            "long",
            "pairs",
            "scores",
            "series",
            body=f"""
            , bounds AS (SELECT min(value) AS lo, (max(value) - min(value)) / 39 AS w FROM series),
            counted AS (SELECT series, least(floor((value - lo) / w), 38)::INT AS bin, count(*) AS n
                        FROM series, bounds GROUP BY 1, 2),
            totals AS (SELECT series, count(*) AS total FROM series GROUP BY series)
            SELECT totals.series, b.bin, {r6('lo + b.bin * w')} AS left_edge, coalesce(n, 0) AS count,
                   {r6('coalesce(n, 0) / (total * w)')} AS density
            FROM bounds, totals, (SELECT unnest(range(39))::INT AS bin) b
            LEFT JOIN counted ON counted.series = totals.series AND counted.bin = b.bin""".lstrip(),
        ),
        "o4_top_activity": with_tables(
            "profiles",
            "long",
            "active",
            "top",
            body=f"""SELECT vec_id, compound AS "Metadata_Compound", {r6('activity')} AS activity
            FROM top""",
        ),
        "a19_similarity": with_tables(
            "profiles",
            "long",
            "active",
            "top",
            body=f"""SELECT a.vec_id AS "left", b.vec_id AS "right", {r6('corr(a.x, b.x)')} AS r
            FROM (SELECT * FROM long WHERE vec_id IN (SELECT vec_id FROM top)) a
            JOIN (SELECT * FROM long WHERE vec_id IN (SELECT vec_id FROM top)) b ON a.i = b.i
            GROUP BY ALL""",
        ),
        "a19_nearest_profiles": with_tables(
            "profiles",
            "long",
            "correlated",
            body=f"""SELECT "left", rank::INT AS rank, "right", {r6('r')} AS r
            FROM (SELECT *, row_number() OVER (PARTITION BY "left" ORDER BY round(r, 12) DESC, "right") AS rank
                  FROM correlated) WHERE rank <= 5""",
        ),
        "a19_similar_profiles": with_tables(
            "profiles",
            "long",
            "correlated",
            body=f"""SELECT "left", "right", {r6('r')} AS r FROM correlated WHERE round(r, 12) >= 0.4""",
        ),
        "w2_category_rank": """
            SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS rank FROM part""",
        "a20_pca2": with_tables("profiles", body=_PLANE),
        "o1_strata_order": with_tables(
            "cells",
            body=f"""SELECT *, row_number() OVER (ORDER BY "Metadata_Plate" NULLS LAST, "Metadata_Well" NULLS LAST) - 1
                AS position
            FROM (SELECT nullif("Metadata_Plate", 'N') AS "Metadata_Plate", "Metadata_Well", {_MEDIANS[1]}
                  FROM cells GROUP BY 1, 2)""",
        ),
        "o2_index_order": with_tables(
            "image_table",
            "site_index",
            body="""SELECT "Metadata_Plate", "Metadata_Well", "Metadata_Site", "DNA",
              row_number() OVER (ORDER BY "Metadata_Plate" NULLS LAST, "Metadata_Well" NULLS LAST,
                try_cast("Metadata_Site" AS DOUBLE) NULLS LAST, "Metadata_Site" NULLS LAST, "DNA" NULLS LAST) - 1
                AS position
            FROM site_index""",
        ),
        "o3_site_order": with_tables(
            *images,
            "sets",
            body="""SELECT "Metadata_Plate", "Metadata_Well", "Metadata_Site",
              row_number() OVER (ORDER BY "Metadata_Plate" NULLS LAST, "Metadata_Well" NULLS LAST,
                "Metadata_Site" NULLS LAST) - 1 AS position
            FROM sets""",
        ),
        "s2_image_table_csv": with_tables("image_table", body="SELECT * FROM image_table"),
        "s3_platemap_csv": with_tables(
            "whole_plate_map",
            body="""SELECT map_plate AS "Metadata_PlateID", map_well AS "Metadata_DestinationWell",
            "Metadata_Compound", "Metadata_Batch" FROM whole_plate_map""",
        ),
        "k3_locations_csv": with_tables("locations", body="SELECT * FROM locations"),
        "k4_chunk_files": with_tables(
            *images, "sets", "chunked", "manifest", body="SELECT * FROM manifest"
        ),
        "k4_chunk_tables": with_tables(
            *images,
            "sets",
            "chunked",
            body="""SELECT "Metadata_Plate", "Metadata_Well", "Metadata_Site", chunk, """
            + ", ".join(f'"Image_FileName_Orig{n}"' for n in _NAMES.values())
            + " FROM chunked",
        ),
        "k5_lossless_parquet": with_tables(
            "cells",
            body="""SELECT "Metadata_Plate", count(*) AS rows, count("Metadata_Well") AS "Metadata_Well",
            count(cell) AS "Metadata_Cell", count("Cells_Quantity") AS "Cells_Quantity",
            count("Nuclei_Price") AS "Nuclei_Price", count("Cytoplasm_Discount") AS "Cytoplasm_Discount"
            FROM cells GROUP BY ALL""",
        ),
        "s4_locations_csv": f"""SELECT {LI_WELL} AS "Metadata_Well",
            (l_orderkey % 4 + 1)::VARCHAR AS "Metadata_Site", count(*) AS rows,
            round(sum(l_quantity / 2), 2) AS x, round(sum(l_extendedprice), 2) AS y
            FROM lineitem GROUP BY ALL""",
        "s9_sqlite_tables": """SELECT l_orderkey, l_linenumber::DOUBLE AS l_linenumber,
            CASE WHEN l_orderkey // 400 % 2 = 1 THEN l_returnflag END AS flag, l_extendedprice AS price
            FROM lineitem""",
        "s10_npz_embeddings": f"""SELECT vec_id, CASE WHEN vec_id // 100 % 2 = 0 THEN 'x' END AS note,
            {r6('list_sum(embedding::DOUBLE[])')} AS total FROM embeddings""",
        "f3_plate_from_name": f"""SELECT CASE WHEN s_nationkey % 2 = 1 THEN 'inside' ELSE 'P' END || s_nationkey
            AS "Metadata_Plate", count(*) AS rows, {r6('max(s_acctbal)')} AS top, sum(s_nationkey)::BIGINT AS nations
            FROM supplier GROUP BY s_nationkey""",
        "s1_image_listing": f"""SELECT 'run_' || {_well("s_suppkey % 16", "s_suppkey % 24")} || '_s' || (s_suppkey % 9 + 1)
                || '_w' || (s_suppkey % 7 + 1) || '_' || s_suppkey || '.tif' AS "FileName",
              'S' AS "Metadata_Plate", {_well("s_suppkey % 16", "s_suppkey % 24")} AS "Well",
              (s_suppkey % 9 + 1)::INT AS "Site", (s_suppkey % 7 + 1)::INT AS "ChannelNumber"
            FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 < 5 AND s_suppkey % 11 <> 0""",
        "a5_plates_of_tables": with_tables(
            "image_table",
            body="""SELECT 'T' || CASE WHEN p % 3 = 0 THEN p ELSE p - p % 3 + 1 END AS "table",
              CASE WHEN count(DISTINCT p) = 1 THEN 'P' || min(p) END AS plate, count(DISTINCT p) AS plates,
              false AS unnamed
            FROM (SELECT substr("Metadata_Plate", 2)::BIGINT AS p FROM image_table) GROUP BY 1""",
        ),
        "s11_profile_files": f"""SELECT o_orderstatus, count(*) AS rows,
            {r6('max(o_totalprice)')} AS top, max(o_custkey::VARCHAR) AS last_key
            FROM orders GROUP BY ALL""",
    }
    sql["a11_replicate_score_blocks"] = sql["a11_replicate_score"]
    sql["u1_parquet_parts"] = sql["u1_strict_union"]
    return sql
