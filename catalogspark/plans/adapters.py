"""Views that give the driver's tables the shape the operators take. The SQL runs in Spark and DuckDB alike."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from catalogspark.session import ship

VIEWS = {
    "v_rel": """
SELECT p_partkey AS seq,
       CASE p_partkey % 4 WHEN 0 THEN upper(p_name) || '!' WHEN 1 THEN p_name || ' ' ELSE p_name END AS movie_title,
       CASE WHEN p_partkey % 11 = 0 THEN 'Unknown'
            WHEN p_partkey % 5 = 0 THEN CAST(1970 + p_size AS STRING) || '-06-15'
            ELSE CAST(1970 + p_size AS STRING) END AS release_date,
       CASE WHEN p_partkey % 7 = 0 THEN 'Unknown' ELSE p_brand END AS studio,
       CASE WHEN p_partkey % 2 = 0 THEN ''
            WHEN p_partkey % 17 = 0 THEN 'x' || CAST(p_partkey AS STRING)
            ELSE replace(p_name, ' ', '-') || '-' || CAST(p_size AS STRING) END AS tmdb_id,
       CASE WHEN p_partkey % 13 = 0 THEN 'tv' ELSE 'movie' END AS media_type,
       CASE WHEN p_partkey % 6 = 0 THEN 'tt' || CAST(100000 + p_size * 1000 + length(p_name) * 26 + ascii(p_name) - 97 AS STRING) ELSE '' END AS imdb_id,
       CASE WHEN p_partkey % 9 = 0 THEN 'HTTP://Shop.Example.com/items/' || replace(p_name, ' ', '-') || '-' || CAST(p_partkey % 2 AS STRING) || '/' || CAST(p_size AS STRING) || '/?ref=' || CAST(p_partkey AS STRING) ELSE '' END AS bluray_url,
       CASE p_partkey % 3 WHEN 0 THEN 'ai-extracted' WHEN 1 THEN 'reddit-list' ELSE 'table-row' END AS evidence_type,
       p_name || ' quote ' || CAST(p_partkey AS STRING) AS quote
FROM part""",
    "v_lines": """
SELECT p_partkey AS seq,
       CASE p_partkey % 5 WHEN 0 THEN CAST(p_partkey AS STRING) || '. ' || p_name || ' [' || CAST(1970 + p_size AS STRING) || ']'
                          WHEN 1 THEN p_name || ' (' || CAST(1970 + p_size AS STRING) || ')'
                          WHEN 2 THEN p_name || ' MEL (' || CAST(1970 + p_size AS STRING) || ')'
                          WHEN 3 THEN 'I watched ' || p_name || ' (' || CAST(1970 + p_size AS STRING) || ') yesterday'
                          ELSE p_name END AS line
FROM part""",
    "v_works": """
SELECT p_partkey AS tmdb_id, p_name AS title, p_name || ' ' || p_type AS original_title,
       CASE WHEN p_partkey % 10 = 0 THEN '' ELSE CAST(1970 + p_size AS STRING) || '-03-01' END AS release_date,
       CAST(p_partkey % 400 AS INT) AS vote_count, p_retailprice AS popularity,
       CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '/p.jpg' END AS poster_path
FROM part""",
    "v_csv": """
SELECT p_partkey AS seq,
       CASE p_partkey % 6 WHEN 0 THEN 'L.E. ' || p_name || ',' || CAST(1970 + p_size AS STRING) || ', http://a.example/' || CAST(p_partkey AS STRING) || ' | http://b.example/x|http://b.example/x'
                          WHEN 1 THEN p_name || ',' || CAST(1970 + p_size AS STRING)
                          WHEN 2 THEN p_name || ',nineteen'
                          WHEN 3 THEN ',' || CAST(1970 + p_size AS STRING)
                          WHEN 4 THEN p_name
                          ELSE '"' || p_name || ', ' || p_brand || '",' || CAST(1970 + p_size AS STRING) || ',' END AS line
FROM part""",
    "v_bitrate": """
SELECT p_partkey AS seq,
       CASE p_partkey % 4 WHEN 0 THEN '  ' || p_name || ' (' || CAST(1970 + p_size AS STRING) || ') FEL - ' || CAST(p_size AS STRING) || '.5 Mb/s (checked)'
                          WHEN 1 THEN p_name || ' (' || CAST(1970 + p_size AS STRING) || ')fel-' || CAST(p_size AS STRING) || 'mb/s'
                          WHEN 2 THEN p_name || ' FEL - 3 Mb/s'
                          ELSE 'note: ' || p_name END AS line
FROM part""",
    "v_sheet": """
SELECT 'sheet-' || CAST(p_partkey % 7 AS STRING) AS sheet, p_partkey AS row_no,
       CASE WHEN p_partkey % 50 < 7 THEN (CASE WHEN p_partkey % 2 = 0 THEN 'Rank,Movie Name,DV Source,Notes' ELSE 'Title,Layer,Other,Notes' END)
            WHEN p_partkey % 50 < 10 THEN 'banner,,,'
            WHEN p_partkey % 3 = 0 THEN '7,' || p_name || ' ' || CAST(1970 + p_size AS STRING) || ',FEL,' || p_brand
            WHEN p_partkey % 3 = 1 THEN p_name || '.' || CAST(1970 + p_size AS STRING) || ',has FEL layer,,' || p_brand
            ELSE p_name || ' Trilogy,FEL,FEL,' END AS line
FROM part""",
    "v_audio": """
SELECT p_partkey AS seq,
       CASE p_partkey % 9 WHEN 0 THEN 'Dolby TrueHD 7.1 Atmos' WHEN 1 THEN 'English DD+ Atmos' WHEN 2 THEN 'DTS:X and DTS-HD Master Audio 7.1'
                          WHEN 3 THEN '  English   Stereo ' WHEN 4 THEN p_name WHEN 5 THEN 'TrueHD 5.1' WHEN 6 THEN 'channel 1234' WHEN 7 THEN '' ELSE 'E-AC3 5.1' END AS audio
FROM part""",
    "v_titles": """
SELECT p_partkey AS seq,
       CASE p_partkey % 10 WHEN 0 THEN 'L.E. EDIT: -- ' || p_name WHEN 1 THEN p_name || ' AKA ' || p_brand WHEN 2 THEN p_name || ' (2021 film)'
                           WHEN 3 THEN '  ' || p_name || '   &amp;  ' || p_brand || ' ,-' WHEN 4 THEN '101 ' || upper(p_name) WHEN 5 THEN '101 Dalmatians ' || p_name
                           WHEN 6 THEN p_name || ' (Musical)' WHEN 7 THEN p_name || ' &#233;t&#xE9;' WHEN 8 THEN p_name || ' (No Way Out)' ELSE 'Café ' || p_name || ' d''Or' END AS title
FROM part""",
    "v_seasons": """
SELECT p_partkey AS seq,
       CASE p_partkey % 10 WHEN 0 THEN p_name || ' Season ' || CAST(p_size AS STRING) WHEN 1 THEN p_name || ': The Complete Third Season' WHEN 2 THEN p_name || ' Seasons 1-3'
                           WHEN 3 THEN p_name || ' The Complete Series' WHEN 4 THEN p_name || ' S0' || CAST(1 + p_size % 9 AS STRING) WHEN 5 THEN 'Season of the ' || p_name
                           WHEN 6 THEN p_name || ' Season Two' WHEN 7 THEN p_name || ': The Complete Final Season' WHEN 8 THEN p_name || ' Extended Cut' ELSE p_name END AS title
FROM part""",
    "v_dates": """
SELECT p_partkey AS seq,
       CASE p_partkey % 5 WHEN 0 THEN 'June 5, ' || CAST(1970 + p_size AS STRING) WHEN 1 THEN 'June 35, 2020' WHEN 2 THEN p_name WHEN 3 THEN 'December 31, 2019' ELSE '' END AS spoken,
       CASE p_partkey % 4 WHEN 0 THEN CAST(1970 + p_size AS STRING) WHEN 1 THEN CAST(1970 + p_size AS STRING) || '-07' WHEN 2 THEN CAST(1970 + p_size AS STRING) || '-07-09' ELSE 'Unknown' END AS written
FROM part""",
    "v_cand": """
SELECT seq, movie_title AS title, CASE WHEN seq % 11 = 0 THEN 'Unknown' ELSE substr(release_date, 1, 4) END AS year, bluray_url AS source_url, quote AS evidence, evidence_type AS extraction_method
FROM v_rel""",
}


def expanded(sql: str) -> str:
    """The query with a WITH clause for every view that it, or a view it uses, names."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in need:
                visit(VIEWS[name])
                if name not in need:
                    need.append(name)

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in need) + "\n" if need else "") + sql.strip()


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An adapter view as a DataFrame over the tables of sf_dir."""
    sql = expanded(f"SELECT * FROM {name}")
    sql = re.sub(r"\bFROM part\b", "FROM {part}", sql)
    return ship(spark).sql(sql, part=spark.read.parquet(f"{sf_dir}/part.parquet"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
