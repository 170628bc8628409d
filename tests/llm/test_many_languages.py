from basketry.llm import quality


def test_languages_beyond_the_broadcast_are_joined(spark, odd, monkeypatch):
    rows = lambda: sorted(map(str, quality.quality_rules(odd).collect()))
    few = rows()
    monkeypatch.setattr(quality, "BROADCAST_LANGUAGES", 0)
    assert rows() == few
