"""CSV and console sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, header: bool = False, mode: str = "errorifexists") -> None:
    """CSV without header, as the log conversion prints it (one part file per task). An existing folder is an
    error unless ``mode`` says otherwise."""
    df.write.mode(mode).option("header", header).csv(path)


def console(df: DataFrame, truncate: bool = False, output_mode: str = "append", available_now: bool = False,
            checkpoint: str | None = None):
    """Print a stream to the console (development); returns the started query.

    ``available_now=True`` drains the current input and stops (finite runs, tests).
    """
    w = df.writeStream.format("console").option("truncate", truncate).outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
