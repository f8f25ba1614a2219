from pyspark.sql import functions as F

from lodgeworks.fields import RAW_SCHEMA
from lodgeworks.operators import rules
from lodgeworks.plans import train
from lodgeworks.plans.ingest import build_features, ingest, load_cleaned, load_training_rows, publish_features
from lodgeworks.sources.bookings import bookings
from lodgeworks.sources.files import read_csv, write_csv


def test_from_raw_csv_to_scored_requests(spark, small, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("raw", "cleaned", "store", "registry")}
    write_csv(bookings(spark, small), paths["raw"])
    ingest(read_csv(spark, paths["raw"], RAW_SCHEMA), paths["cleaned"], keep_id=True)

    cleaned = load_cleaned(spark, paths["cleaned"])
    assert cleaned.count() == 1_500
    assert not [f for f in rules.check_schema(cleaned).findings if f.check in ("type", "not_null", "present")]
    pruned = cleaned.filter("arrival_year = 2017")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in pruned and "arrival_year" in pruned.split("PartitionFilters: [")[1].split("]")[0]

    out = build_features(cleaned, "2024-02-01 00:00:00", trees=5, depth=4)
    publish_features(out.features, paths["store"])
    rows = load_training_rows(spark, paths["store"])
    assert rows.count() == 1_500

    labelled = rows.withColumn("likely", (F.col("lead_time") > 200).cast("int"))
    data = train.prepare(labelled, "likely")
    best, results = train.train(data, ["random_forest", "logistic_regression"], params={"random_forest": {"trees": 20, "depth": 8}})
    assert len(results) == 2
    train.gate(best.model, data.parts["test"])
    model = train.scoring_model(data.scaler, best.model)
    train.register(spark, model, best.name, paths["registry"], 1, best.accuracy, "2024-02-01 00:00:00")
    scored = train.score(train.load_registered(spark, paths["registry"]), train.request_frame(rows))
    assert scored.count() == 1_500 and scored.columns[-1] == "booking_status"
