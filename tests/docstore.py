"""A document store for tests, as a Spark data source named by its options alone: one JSON
file per document, named by its ``_id``, so writing a document again replaces it. A document
without an ``_id`` gets a fresh one, as in document stores."""

from __future__ import annotations


def register(spark) -> str:
    """Register the source; returns its format name. The classes are local, so that they
    travel to Python workers by value."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

    class Writer(DataSourceWriter):
        def __init__(self, schema, folder, overwrite):
            self.names, self.folder, self.overwrite = schema.fieldNames(), folder, overwrite
            if overwrite:
                import glob
                import os

                for p in glob.glob(f"{folder}/*.json"):
                    os.remove(p)

        def write(self, rows):
            import json
            import os
            import uuid

            os.makedirs(self.folder, exist_ok=True)
            for row in rows:
                doc = row.asDict(recursive=True)
                doc.setdefault("_id", uuid.uuid4().hex)
                part = f"{self.folder}/{uuid.uuid4().hex}.part"
                with open(part, "w") as f:
                    json.dump(doc, f, default=str)
                os.replace(part, f"{self.folder}/{doc['_id']}.json")
            return WriterCommitMessage()

    class Reader(DataSourceReader):
        def __init__(self, schema, folder):
            self.schema, self.folder = schema, folder

        def partitions(self):
            return [InputPartition(i) for i in range(2)]

        def read(self, partition):
            import datetime
            import glob
            import json

            from pyspark.sql import types as T

            def value(v, t):
                if v is None:
                    return None
                if isinstance(t, T.TimestampType):
                    return datetime.datetime.fromisoformat(v).replace(tzinfo=datetime.timezone.utc)
                if isinstance(t, T.DateType):
                    return datetime.date.fromisoformat(v)
                if isinstance(t, T.StructType):
                    return tuple(value(v.get(f.name), f.dataType) for f in t.fields)
                return v

            for p in sorted(glob.glob(f"{self.folder}/*.json"))[partition.value :: 2]:
                with open(p) as f:
                    doc = json.load(f)
                yield tuple(value(doc.get(f.name), f.dataType) for f in self.schema.fields)

    class Documents(DataSource):
        @classmethod
        def name(cls):
            return "test_documents"

        def folder(self):
            return f"{self.options['database']}/{self.options['collection']}"

        def schema(self):
            raise ValueError("documents have no schema of their own: name one")

        def reader(self, schema):
            return Reader(schema, self.folder())

        def writer(self, schema, overwrite):
            return Writer(schema, self.folder(), overwrite)

    spark.dataSource.register(Documents)
    return Documents.name()
