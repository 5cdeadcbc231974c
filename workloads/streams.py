"""A stream of events in three waves, each landed and taken before the next."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltgate.session import configure, new_path
from siltgate.streaming.ledger import Ledger, load_stream
from workloads.inputs import sql
from workloads.registry import query

# Some early events come a wave late; the last wave is behind the second for the most part.
WAVES = """
select event_id as id, event_type as source_name, value,
  case when event_id <= 0.6 * top and event_id % 7 != 0 then 0
       when event_id <= 0.6 * top or event_id % 5 != 0 then 1 else 2 end as wave
from events, (select max(event_id) as top from events) m
"""
STREAM = "id bigint, source_name string, value double"


@query(
    "stream_late_counts",
    f"""with waves as ({WAVES}),
      first as (select source_name, max(id) as mark from waves where wave = 0 group by source_name),
      second as (select source_name, max(id) as mark from waves where wave <= 1 group by source_name)
      select w.wave::bigint as batch, w.source_name, count(*) as n_rows,
        count(*) filter (w.wave = 1 and w.id <= f.mark or w.wave = 2 and w.id <= s.mark) as late,
        count(*) filter (not coalesce(w.wave = 1 and w.id <= f.mark or w.wave = 2 and w.id <= s.mark, false)) as loaded
      from waves w left join first f on w.source_name = f.source_name left join second s on w.source_name = s.source_name
      group by w.wave, w.source_name""",
)
def stream_late_counts(spark, sf_dir):
    configure(spark)
    waves = sql(spark, sf_dir, WAVES, "events")
    inbox, out, state = (new_path(spark, f"stream-{part}") for part in ("in", "out", "state"))
    ledger = Ledger(spark, f"{out}/ledger")

    def load(rows, batch):
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/rows/wave{batch}")

    for wave in range(3):
        waves.where(F.col("wave") == wave).drop("wave").write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(STREAM).parquet(inbox)
        load_stream(stream, ledger, load, state).awaitTermination()
    found = [(e.batch, s, n, e.late[s]) for e in ledger.entries() for s, n in e.rows.items()]
    told = spark.createDataFrame(found, "batch bigint, source_name string, n_rows bigint, late bigint")
    rows = spark.read.schema(f"{STREAM}, batch bigint").parquet(*[f"{out}/rows/wave{b}" for b in {f[0] for f in found if f[2] > f[3]}])
    loaded = rows.groupBy("batch", "source_name").agg(F.count("*").alias("loaded"))
    return told.join(loaded, ["batch", "source_name"], "left").fillna(0, ["loaded"])
