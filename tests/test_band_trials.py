import inspect
import os

import pytest


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables here")
def test_bands_take_the_trials_of_the_reference(spark, monkeypatch):
    from threadloom.operators import style
    from threadloom.queries import queries

    asked, band = [], style.self_distance_band
    signature = inspect.signature(band)

    def spy(*a, **k):
        b = signature.bind(*a, **k)
        b.apply_defaults()
        asked.append(b.arguments["trials"])
        return band(*a, **k)

    monkeypatch.setattr(style, "self_distance_band", spy)
    for name in ("self_distance_band", "corpus_distance"):
        queries()[name](spark, "/root/testdata/sf0.01")
    assert asked == [200, 200]
