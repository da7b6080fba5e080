"""Scoring a stream of request files: the batch plan on an unbounded input, without state."""

from riskloom.operators.scoring import score_requests
from riskloom.sources.requests import complete_requests, raw_requests


def request_stream(spark, path, files_per_trigger=None):
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return raw_requests(reader, path)


def score_stream(source, model, means, sink, checkpoint, on_reject="fail"):
    """Start scoring what has arrived and stop (``availableNow``); appends Parquet to ``sink``.

    A request that cannot be scored stops the stream with its reason; with ``on_reject="skip"`` it
    is passed over and can be read with ``sources.requests.read_rejected_requests``.

    The checkpoint remembers the files done, so a restart scores only new ones.
    """
    scored = score_requests(complete_requests(source, on_reject), model, means)
    return (
        scored.writeStream.format("parquet").outputMode("append")
        .option("path", sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
