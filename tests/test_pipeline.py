"""The whole way: CSV files, six table plans, star join, model, predictions."""

from catalog.credit_tables import credit_tables
from creditloom.plans import modelling, pipeline
from creditloom.sources.sinks import Paths, write_predictions
from creditloom.sources.tables import load_tables, read_csv
from creditloom.sources.schemas import schema_of


def test_from_files_to_predictions(spark, tmp_path):
    source = credit_tables(spark, "/root/testdata/sf0.001")
    application = source.pop("application")
    source |= {"application_train": application, "application_test": application.drop("TARGET")}
    for name, df in source.items():
        df.write.option("header", True).csv(f"{tmp_path}/in/{name}.csv")
    tables = load_tables(spark, f"{tmp_path}/in")
    assert tables["bureau"].count() == source["bureau"].count()

    paths = Paths(f"{tmp_path}/out")
    train, test = pipeline.run(tables, paths, trees=2, term_trees=2, neighbours=20)
    assert train.count() == application.where("CODE_GENDER <> 'XNA'").count()  # train only
    assert test.count() == application.count()
    assert "TARGET" in train.columns and "TARGET" not in test.columns
    assert len(train.columns) > 1200 and set(test.columns) < set(train.columns)

    columns = ["EXT_SOURCE_MEAN", "CREDIT_INCOME_RATIO", "TARGET_NEIGHBORS_20_MEAN", "AMT_CREDIT_SUM_MEAN_OVERALL"]
    out = modelling.run(train, test, "logistic", select=False, draws=1, columns=columns)
    write_predictions(out.test, paths.result("logistic"))
    back = read_csv(spark, paths.result("logistic"), schema_of(["SK_ID_CURR"]).add("TARGET", "double"))
    scores = back.toPandas()
    assert len(scores) == application.count() and scores.TARGET.between(0, 1).all()
    assert 0 <= out.report.first()["auc"] <= 1
