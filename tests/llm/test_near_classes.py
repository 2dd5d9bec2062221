"""Numbering the classes of near-dedup writes their bands and sketches once."""

from geolayer.llm import near_dedup


def test_bands_are_written_once(spark, monkeypatch):
    seen = []

    def kept(df, name="cut"):
        seen.append((name, "bands" in df.columns))
        return df.cache()

    monkeypatch.setattr(near_dedup, "written", kept)
    rows = spark.sql("""SELECT id AS doc_id, IF(id < 8, 2L, 0L) AS n_shingles,
        IF(id < 8, CAST(CAST(id div 2 AS string) AS binary), NULL) AS digest,
        array(id div 2) AS bands, array(id div 2) AS odd FROM range(9)""")
    nodes = near_dedup._classes(rows).orderBy("node").collect()
    assert [(r.id, r.n, r.bands, r.odd) for r in nodes] == [(2 * i, 2, [i], [i]) for i in range(4)]
    assert sum(wide for _, wide in seen) == 1
