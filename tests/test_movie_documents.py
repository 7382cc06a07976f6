"""The movie document shape end to end: land -> raw -> bronze -> silver -> repair."""

from __future__ import annotations

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from silverline.contract import MOVIE_CONTRACT
from silverline.plans.land import export_raw, land_source
from silverline.plans.store import MedallionStore
from silverline.session import scratch_path


def _movie(i, budget, runtime, genres, **extra):
    m = {"Id": i, "Title": f"Movie {i}", "Overview": "o", "Tagline": "t", "Budget": budget, "Revenue": "9",
         "ImdbUrl": "u", "TmdbUrl": "u", "PosterUrl": "u", "BackdropUrl": "u", "OriginalLanguage": "en",
         "ReleaseDate": "2020-01-0%d" % (1 + len(str(i)) % 5), "RunTime": runtime, "Price": "1",
         "CreatedDate": "2021-04-03T16:51:30.1633333", "UpdatedDate": "2021-04-04", "UpdatedBy": "a",
         "CreatedBy": "b", "genres": genres}
    m.update(extra)
    return m


def _write_sources(root):
    docs = {
        "movie_0.json": [_movie(1, 2_000_000, 100, [{"id": 1, "name": "Drama"}, {"id": 2, "name": "Crime"}]),
                         _movie(2, 500, 90, [{"id": 2, "name": "Crime"}]),
                         _movie(3, 3_000_000, -80, [])],
        "movie_1.json": [_movie(1, 2_000_000, 100, [{"id": 1, "name": "Drama"}, {"id": 2, "name": "Crime"}]),
                         _movie(4, None, 70, [{"id": 3, "name": "Comedy"}]),
                         _movie("uuid-x", 5_000_000, 70, [{"id": 3, "name": "Comedy"}])],
        "other.json": [_movie(99, 9_000_000, 1, [])],
    }
    for name, movies in docs.items():
        sub = os.path.join(root, name.replace(".json", ""))
        os.makedirs(sub)
        with open(os.path.join(sub, "doc.json"), "w") as f:
            json.dump({"movie": [{k: v for k, v in m.items() if v is not None} for m in movies]}, f, indent=2)


def test_movie_documents_end_to_end(spark):
    root = scratch_path(spark, "movies")
    src = os.path.join(root.replace("file:", ""), "source")
    _write_sources(src)
    landing = land_source(spark, f"{src}/movie_*", f"{root}/landing")
    assert landing.count() == 6                           # other.json is not a movie_ file
    export_raw(spark, f"{root}/landing", f"{root}/raw/2024-01-01")
    store = MedallionStore(spark, f"{root}/tables", MOVIE_CONTRACT)
    store.run_batch(raw_path=f"{root}/raw/2024-01-01")

    silver = store.table("silver")
    assert sorted(r.movie_id for r in silver.collect()) == [1]            # the duplicate line loads once
    row = silver.first()
    assert row.CreatedDate == dt.date(2021, 4, 3) and row.UpdatedDate == dt.date(2021, 4, 4)
    assert dict(silver.dtypes)["movie_id"] == "int" and dict(silver.dtypes)["RunTime"] == "bigint"
    assert store.table("silver_movie").columns == [c for c in silver.columns if c != "genres"]
    assert sorted(tuple(r) for r in store.table("genre_dim").collect()) == [(1, "Drama"), (2, "Crime"), (3, "Comedy")]
    assert sorted(tuple(r) for r in store.table("bridge").collect()) == [(1, 1), (1, 2), (2, 2), (4, 3)]
    assert store.table("language").count() == 5                          # with and without a typed key

    statuses = {r.status: r["count"] for r in store.bronze().groupBy("status").count().collect()}
    assert statuses == {"loaded": 2, "quarantined": 4}

    store.run_repair()
    fixed = {r.movie_id: (r.Budget, r.RunTime) for r in store.table("silver").collect()}
    assert fixed == {1: (2e6, 100), 2: (1e6, 90), 3: (3e6, 80), 4: (1e6, 70)}
    left = store.bronze().where(F.col("status") == "quarantined")
    assert [r.Id for r in left.select(F.get_json_object("value", "$.Id").alias("Id")).collect()] == ["uuid-x"]
