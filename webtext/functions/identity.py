"""Document ids, titles and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions import html as H
from webtext.functions import urls as U

# Time stamp formats.
FILE_STAMP = "yyyyMMdd_HHmmss"
TEXT_STAMP = "yyyy-MM-dd HH:mm:ss"


def document_id(url: Column) -> Column:
    """The URL's md5 laid out as a UUID.

    A random id would change when a lost task is run again, and every stage
    after it would disagree; this one is a function of the URL.
    """
    return F.regexp_replace(
        F.md5(url), r"\A(.{8})(.{4})(.{4})(.{4})(.{12})\z", "$1-$2-$3-$4-$5"
    )


def full_title(url: Column, html: Column) -> Column:
    return F.concat(U.slug(url), F.lit(" "), H.title(html))


def file_stamp(ts: Column) -> Column:
    return F.date_format(ts, FILE_STAMP)


def text_stamp(ts: Column) -> Column:
    return F.date_format(ts, TEXT_STAMP)
