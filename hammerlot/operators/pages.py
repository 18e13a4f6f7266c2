"""Pages of catalogues: which to read, what is still to do, and their texts as one document."""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hammerlot.functions import text as T

#: Separator that a transcription puts around each lot, and most tokens it may generate.
SEPARATOR, MOST_TOKENS = "---------", 20480

PROMPT = (
    "Transcribe the catalogue page %s as Markdown, in its own language and without comments. "
    "Leave out page numbers, running headers and ornaments. Put the line " + SEPARATOR + " before and after every lot, "
    "a lot being a numbered paragraph with the smaller print that belongs to it. Mark titles as headings where they stand. "
    "Put words you cannot read for certain between backticks."
)


def folder_pages(pages: DataFrame, filename: str = "filename") -> DataFrame:
    """``(folder_id, filename)`` for every listed page that names a folder; nulls and other names are left out."""
    named = pages.select(F.expr(T.folder_id(filename)).alias("folder_id"), F.col(filename).alias("filename"))
    return named.where("folder_id is not null")


def folder_index(pages: DataFrame, filename: str = "filename", order: str | None = None) -> DataFrame:
    """``(folder_id, n_pages, filenames)``: the pages of each folder in file-name order or in that of the column
    ``order``, repeated names kept. A page list has no order of its own; one that shall keep its lines' order has a
    column for it."""
    if order is None:
        grouped = folder_pages(pages, filename).groupBy("folder_id").agg(F.array_sort(F.collect_list("filename")).alias("filenames"))
    else:
        named = pages.select(F.expr(T.folder_id(filename)).alias("folder_id"), F.col(order).alias("o"), F.col(filename).alias("f")).where("folder_id is not null")
        grouped = named.groupBy("folder_id").agg(F.array_sort(F.collect_list(F.struct("o", "f"))).alias("p")).select("folder_id", F.col("p.f").alias("filenames"))
    return grouped.select("folder_id", F.size("filenames").cast("bigint").alias("n_pages"), "filenames")


def select_pages(files: DataFrame, pages: DataFrame, folders: list[str] | None = None, filename: str = "filename") -> DataFrame:
    """Files that some folder of the page list names, of the allowed folders (``folder`` column) only, if any are given."""
    allowed = files if folders is None else files.where(F.col("folder").isin(folders))
    return allowed.join(folder_pages(pages, filename).select("filename").distinct(), "filename", "left_semi")


def pending_pages(files: DataFrame, done: DataFrame, on: str = "page") -> DataFrame:
    """Files without a finished transcription. Files with a null name are pending."""
    return files.join(done.select(on).distinct(), on, "left_anti")


def missing_documents(listed: DataFrame, documents: DataFrame, key: str = "catalogue_id") -> DataFrame:
    """``(key, error)``: listed catalogues without a text, the dead letters of reading. Null keys are none."""
    gone = listed.where(F.col(key).isNotNull()).select(key).distinct().join(documents.select(key).distinct(), key, "left_anti")
    return gone.withColumn("error", F.lit("no text"))


def page_name(x: str) -> str:
    """SQL: name of a page without folder and extension."""
    return f"regexp_replace(substring_index({x}, '/', -1), '\\\\.[^.]*$', '')"


def concat_pages(pages: DataFrame, key: str = "catalogue_id", order: str = "page", text: str = "text", result: str = "all.md") -> DataFrame:
    """``(key, n_pages, text)``: texts of each catalogue in page order, a line break after each.

    A page named as the result itself is not taken in again; null texts are left out. A catalogue is one value, so it
    must fit in memory as it must in a file.
    """
    taken = pages.where(F.col(text).isNotNull() & ~F.col(order).cast("string").eqNullSafe(F.lit(result)))
    grouped = taken.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: F.concat(x["t"], F.lit("\n"))), "")
    return grouped.select(key, F.size("p").cast("bigint").alias("n_pages"), joined.alias("text"))


def render_prompts(pages: DataFrame, filename: str = "filename") -> DataFrame:
    """``pages`` with ``prompt``, the instruction for transcribing the page."""
    return pages.withColumn("prompt", F.format_string(PROMPT, F.col(filename)))


def transcribe(pages: DataFrame, transcriber: Callable[[], Callable[[str, bytes | None], str]], content: str | None = None, filename: str = "filename") -> DataFrame:
    """``(filename, text, error)``: each page through a transcriber that is made once per task.

    ``transcriber()`` returns a function from file name and content (the bytes, grey or not, or None) to text. An empty
    result or an exception gives a null text and the reason; nothing stops the run. Errors are the dead letters.
    """
    body = F.col(content) if content else F.lit(None).cast("binary")
    source = pages.select(F.col(filename).alias("filename"), body.alias("content"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = transcriber()
        for batch in batches:
            texts, errors = [], []
            for name, data in zip(batch["filename"], batch["content"], strict=True):
                try:
                    text = read(name, bytes(data) if data is not None else None)
                    texts.append(text or None)
                    errors.append(None if text else "empty transcription")
                except Exception as e:
                    texts.append(None)
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"filename": batch["filename"], "text": texts, "error": errors})

    return source.mapInPandas(run, "filename string, text string, error string")


def echo_transcriber() -> Callable[[str, bytes | None], str]:
    """A stand-in where no recognition library is installed: a text that names the page."""
    return lambda name, _: f"## 1 - {name}" if name else ""


def grey(pixels: np.ndarray) -> np.ndarray:
    """Luminance of RGB pixels (last axis) by the weights 299, 587 and 114 per thousand, rounded down after adding a half."""
    return ((pixels.astype(np.int64) @ np.array([19595, 38470, 7471]) + 0x8000) >> 16).astype(np.uint8)


def grey_image(content: bytes) -> bytes:
    """A colour image in grey: portable pixmaps (P6) by ``grey``, other formats where an imaging library is installed.

    Anything else raises ``ValueError``.
    """
    header = re.match(rb"P6\s(?:#[^\n]*\n)?\s*(\d+)\s+(\d+)\s+(\d+)\s", content)
    if header:
        width, height, most = map(int, header.groups())
        body = content[header.end() :]
        if most > 255 or len(body) != 3 * width * height:
            raise ValueError("pixmap cut short or of more than 8 bits")
        return b"P5 %d %d %d\n" % (width, height, most) + grey(np.frombuffer(body, np.uint8).reshape(-1, 3)).tobytes()
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("no library to decode this image") from None
    out = io.BytesIO()
    Image.open(io.BytesIO(content)).convert("L").save(out, "PNG")
    return out.getvalue()


def run_pages(
    images: DataFrame, folder: str, transcriber: Callable[[], Callable[[str, bytes | None], str]], finished: DataFrame | None = None
) -> DataFrame:
    """Transcribe the pages of ``images(folder, filename, content)`` that have no text yet; ``(folder, filename, error)`` of each.

    The grey image goes to ``<folder>/<catalogue>/grey/<page>``, the text to ``<folder>/<catalogue>/md/<page>.md``, each
    written under another name first, so a lost task leaves no half file and may run again. ``finished(folder, page)``
    are the pages done before. An image that cannot be read or an empty text gives an error and no text.
    ``folder`` is storage that all executors share. Nothing is written until the result is read.
    """
    name = F.expr(page_name("filename"))
    todo = images.select("folder", "filename", "content", name.alias("page"))
    if finished is not None:
        todo = todo.join(finished.select("folder", "page").distinct(), ["folder", "page"], "left_anti")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        read = transcriber()

        def put(path: str, data: bytes) -> None:
            store.create_dir(path.rsplit("/", 1)[0], recursive=True)
            part = f"{path}.part-{uuid.uuid4().hex}"
            with store.open_output_stream(part) as out:
                out.write(data)
            store.move(part, path)

        for batch in batches:
            errors = []
            for where, filename, page, content in zip(batch["folder"], batch["filename"], batch["page"], batch["content"], strict=True):
                try:
                    image = grey_image(bytes(content))
                    put(f"{root}/{where}/grey/{filename}", image)
                    text = read(filename, image)
                    if text:
                        put(f"{root}/{where}/md/{page}.md", text.encode())
                    errors.append(None if text else "empty transcription")
                except Exception as e:
                    errors.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"folder": batch["folder"], "filename": batch["filename"], "error": errors})

    return todo.mapInPandas(run, "folder string, filename string, error string")
