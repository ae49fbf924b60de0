"""The post relation that the given ``events`` and ``documents`` tables make up.

Every event is a post. Its wording (retweet mark, opinion, subject, decoration)
follows from its numbers, and a document whose id equals the event id adds its
whole text and its language; other posts come without a language. Every event
and every whole document is used once. Both tables grow with the data, so the
join is by shuffle, which also spreads the texts over all tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTS_SQL = """
SELECT /*+ MERGE(d) */ e.event_id AS arrival_seq,
 CAST(CASE WHEN e.event_id % 50 = 49 THEN e.event_id - 1 ELSE e.event_id END AS VARCHAR(20)) AS tweet_id,
 'u' || CAST(e.user_id AS VARCHAR(20)) AS username,
 CASE WHEN e.event_id % 17 = 0 THEN 'RT ' ELSE '' END ||
 CASE e.event_id % 11 WHEN 0 THEN 'I love this' WHEN 1 THEN 'This is not good' WHEN 2 THEN 'VERY bad news'
   WHEN 3 THEN 'never been happy' WHEN 4 THEN 'good but terrible ending' WHEN 5 THEN 'it is okay'
   WHEN 6 THEN 'Soooo GREAT' WHEN 7 THEN 'extremely sad' WHEN 8 THEN 'we don''t hate it' ELSE 'just reports' END || ' ' ||
 CASE e.event_id % 7 WHEN 0 THEN 'Bitcoin and blockchain' WHEN 1 THEN 'ChatGPT vs election' WHEN 2 THEN 'climate change'
   WHEN 3 THEN 'the NBA goals' WHEN 4 THEN 'senate policies' WHEN 5 THEN 'machine learning' ELSE 'weather' END || ' ' ||
 CASE e.event_id % 5 WHEN 0 THEN '@user' || CAST(e.user_id AS VARCHAR(20))
   WHEN 1 THEN 'https://t.co/x' || CAST(e.event_id AS VARCHAR(20))
   WHEN 2 THEN '#tag' || CAST(e.user_id % 9 AS VARCHAR(20))
   WHEN 3 THEN 'this &amp; that &lt;3' ELSE '😀!!!' END ||
 coalesce(' ' || d.text, '') AS text,
 d.lang AS lang,
 CAST(floor(e.value / 50) AS INT) AS retweet_count,
 CAST(regexp_extract(e.props, '[0-9]+', 0) AS INT) AS like_count,
 CAST(e.ts AS TIMESTAMP) AS created_at
FROM {events} e LEFT JOIN {documents} d ON d.doc_id = e.event_id
"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from(
        spark.read.parquet(f"{sf_dir}/events.parquet"),
        spark.read.parquet(f"{sf_dir}/documents.parquet"),
    )


def posts_from(events: DataFrame, documents: DataFrame) -> DataFrame:
    return events.sparkSession.sql(POSTS_SQL, events=events, documents=documents)
