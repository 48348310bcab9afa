"""Table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf


@udtf(returnType="at int, name string, email string")
class ContactsOf:
    """Contacts of a cell such as ``Ann <ann@x.org>; Bob <bob@x.org>``, one row each."""

    def eval(self, cell: str):
        for at, part in enumerate(p.strip() for p in (cell or "").split(";")):
            if part:
                name, _, rest = part.partition("<")
                yield at, name.strip() or None, rest.rstrip("> ").strip() or None


def register(spark: SparkSession) -> None:
    spark.udtf.register("contacts_of", ContactsOf)
