"""What the named queries keep can be given back."""

from __future__ import annotations

import os
import uuid

from star_data import SF_SMALL

from starmart.checkpoint import app_root
from starmart.plans import queries as K


def test_release_forgets_and_deletes(spark, monkeypatch, tmp_path):
    kept = dict(K._CACHE)
    K._CACHE.clear()
    # A folder of its own, as other tests' tables are still in use.
    folder = f"{tmp_path}/{uuid.uuid4().hex}"
    monkeypatch.setattr(K, "app_root", lambda s: folder)
    try:
        n = K._trips(spark, SF_SMALL).count()
        other = K._memo(spark, "/elsewhere/", "x", lambda: 7)
        os.makedirs(folder)
        assert K.release(spark, SF_SMALL + "/") == 1 and os.path.exists(folder) and other == 7
        assert K.release(spark) == 1 and not os.path.exists(folder) and not K._CACHE
        assert K._trips(spark, SF_SMALL).count() == n and app_root(spark)
    finally:
        K._CACHE.clear()
        K._CACHE.update(kept)
