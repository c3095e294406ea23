"""Text files and folders as one ``value`` column."""


def read_lines(spark, path):
    return spark.read.text(path)


def stream_lines(spark, path, max_files_per_trigger=None):
    """New files of a folder, as they arrive."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
