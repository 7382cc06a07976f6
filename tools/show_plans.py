"""Print the physical plan trees of the main stages (broadcast off, as when every side is large)."""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from silverline import registry as Rg  # noqa: E402
from silverline.contract import ORDER_CONTRACT  # noqa: E402
from silverline.fixtures import order_feed as feed  # noqa: E402
from silverline.operators import derive as D  # noqa: E402
from silverline.operators import routing as R  # noqa: E402
from silverline.plans.store import MedallionStore, row_key  # noqa: E402
from silverline.session import build_session, scratch_path  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n")[0]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    store = MedallionStore(spark, scratch_path(spark, "plans"), ORDER_CONTRACT)
    store.run_batch(raw_path=Rg.raw_feed_path(spark, sf))
    st = store.table("staging")
    clean = st.where(F.col("route") == "clean")
    stages = {
        "feed build (fixture)": feed.feed_lines(spark, sf),
        "parse + route (staging write)": Rg.routed(spark, sf),
        "silver wide write": D.silver_wide(R.dedupe_records(clean), ORDER_CONTRACT)
            .hint("rebalance", ORDER_CONTRACT.partition_column),
        "genre rows": D.genre_rows(st, ORDER_CONTRACT),
        "append to a narrow table": store._unknown(
            D.exploded_genres(st, ORDER_CONTRACT).withColumn("row_key", row_key(["source_id", "genres_id", "name"])), "genre", "row_key", []),
        "open bronze, status = new": store.open_rows().where(F.col("status") == "new"),
        "apply_status (general merge)": Rg.q_stage_status(spark, sf),
        "bridge_join": Rg.q_bridge_join(spark, sf),
        "repair_by_lookup": Rg.q_repair_lookup(spark, sf),
    }
    for name, df in stages.items():
        print(f"### {name}\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
