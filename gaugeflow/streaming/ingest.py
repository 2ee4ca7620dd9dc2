"""Keep a wide table up to date from a topic."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gaugeflow.functions.parsing import parse_sensor
from gaugeflow.operators.alerts import low_pressure
from gaugeflow.operators.preview import first_rows, show
from gaugeflow.operators.wide_table import WideTable
from gaugeflow.streaming.query import checkpoint_id, start


def stream_to_table(
    records: DataFrame,
    table: WideTable,
    run: str,
    checkpoint: str,
    bounded: bool = True,
    echo: bool = False,
) -> StreamingQuery:
    """Upsert every micro-batch's readings and alerts.

    ``run`` names the checkpoint: keep it when the checkpoint resumes, take
    another name with a new checkpoint. The table binds the run to the
    checkpoint's id and refuses another one. A bad line fails the batch before any
    of it is written. ``echo`` prints the batch's first records and first
    alert as they were written, so each line is still parsed once.
    """

    owner: list[str] = []

    def handle(batch: DataFrame, number: int) -> None:
        if not owner:
            owner.append(checkpoint_id(batch.sparkSession, checkpoint))
        sensor = parse_sensor(batch, keep=("offset",))
        table.put_readings(sensor, run, number, owner[0])
        if echo:
            written = table.batch_rows("data", run, number).drop("run", "batch", "day")
            show("first records", first_rows(written, 10, "version"))
            show("first alert", first_rows(low_pressure(written), 1, "version"))

    return start(records, handle, checkpoint, bounded)
