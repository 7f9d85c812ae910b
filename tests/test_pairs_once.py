"""Pairs that several aggregates read are made once."""


def test_three_levels_make_their_pairs_once(spark, data, monkeypatch):
    from fluvion.plans import registry, release

    made = spark.sparkContext.accumulator(0)
    paired = release.paired

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    def counted(session, sf):
        p = paired(session, sf)
        return p.mapInArrow(count, p.schema)

    monkeypatch.setattr(release, "paired", counted)
    rows = registry.QUERIES["metrics_three_levels"](spark, data).collect()
    n = sum(r["n"] for r in rows if r["scope"] == "all")
    assert n > 0 and made.value == n
