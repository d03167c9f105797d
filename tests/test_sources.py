from pyspark.sql import types as T

from panelkit.operators.clean import clean_data
from panelkit.operators.features import add_ratios
from panelkit.operators.labels import encode_multilabel, fit_labels
from panelkit.session import fresh_path
from panelkit.sources import read_panel_csv
from panelkit.sources.panel import PANEL_SPEC, derived_panel
from panelkit.spec import CREDIT_PANEL
from panelkit.streaming import clean_stream, stream_to_table


def test_csv_tokens(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('a,b,c\nNA,1.5,"x, ""y"""\n28_,n/a,null\n,bad,z\n')
    schema = T.StructType().add("a", "string").add("b", "double").add("c", "string")
    rows = [tuple(r) for r in read_panel_csv(spark, str(path), schema).collect()]
    assert rows == [(None, 1.5, 'x, "y"'), ("28_", None, None), (None, None, "z")]


def test_credit_columns(spark):
    df = spark.createDataFrame(
        [("1", "C", 1, "28_", "22 Years and 1 Months", "_", 5797, "Good")],
        "ID string, Customer_ID string, Month_Number int, Age string, Credit_History_Age string, Credit_Mix string, Interest_Rate int, Credit_Score string",
    )
    row = clean_data(df, CREDIT_PANEL).first()
    assert (row.Age, row.Credit_History_Age_Months, row.Credit_Mix, row.Interest_Rate, row.Credit_Score) == (28.0, 265, None, None, "Good")
    assert "ID" not in row.asDict() and "Customer_ID" not in row.asDict()


def test_stream_gives_the_batch_rows(spark, sf):
    source, target = fresh_path(spark, "raw"), fresh_path(spark, "clean")
    panel = derived_panel(spark, sf)
    panel.write.parquet(source)
    labels = fit_labels(panel, PANEL_SPEC)
    stream = spark.readStream.schema(panel.schema).parquet(source)
    stream_to_table(clean_stream(stream, PANEL_SPEC, labels), target, fresh_path(spark, "progress")).awaitTermination()
    batch, _ = encode_multilabel(clean_data(panel, PANEL_SPEC, "domain", keep_keys=True), PANEL_SPEC, labels)
    batch = add_ratios(batch, PANEL_SPEC)
    got = spark.read.parquet(target).select(*batch.columns)
    assert got.count() == 1500 and got.exceptAll(batch).count() == 0
