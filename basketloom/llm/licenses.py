"""License scan: TF-IDF cosine of lines, windows and whole files to license templates, then inheritance from the nearest
ancestor directory."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketloom.llm.columns import written
from basketloom.llm.license_forms import KEYS, Form, Windows, known_forms

# The usual one-line notices of common licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Licensed under the Mozilla Public License, version 2.0.",
}
#: Least cosine of a line that counts as a notice.
THRESHOLD = 0.8
#: No term begins or ends inside a run of letters and digits.
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+(?![a-z0-9]))*")


def terms(line: str) -> list[str]:
    return _TERM.findall(line.lower())


def window_forms(templates: dict[str, str]) -> list[Form]:
    """The one-line notices, which may stand inside a longer line or be wrapped; with the fixed templates also titles,
    headers, SPDX tags and full texts."""
    own = [Form(name, text, frozenset(t for t in terms(text) if t in KEYS.get(name, "").split()), notice=True) for name, text in sorted(templates.items())]
    return own + (known_forms(terms) if templates == TEMPLATES else [])


class Matcher:
    """Cosines of sparse TF-IDF vectors to the templates; only terms of the templates can add to a product."""

    def __init__(self, templates: dict[str, str], idf: dict[str, float], unseen: float, threshold: float = THRESHOLD):
        self.unseen, self.idf = unseen, idf
        self.vectors: dict[str, dict[str, float]] = {}
        for term, name, weight in ((t, name, n * idf[t]) for name, text in sorted(templates.items()) for t, n in Counter(terms(text)).items()):
            self.vectors.setdefault(term, {})[name] = weight
        self.norms = {name: math.sqrt(sum(v.get(name, 0.0) ** 2 for v in self.vectors.values())) for name in templates}
        heavy = set().union(*(self._telling(name, threshold) for name in templates))
        self.pattern = f"(?<![a-z0-9])(?:{'|'.join(map(re.escape, sorted(heavy)))})(?![a-z0-9])" if heavy else r"(?!)"

    def _telling(self, name: str, threshold: float) -> set[str]:
        """The heaviest terms of a template, as many as it takes that a line with none of them stays below the threshold:
        its cosine is at most the root of the other terms' share of the template's square."""
        squares = {t: v[name] ** 2 for t, v in self.vectors.items() if name in v}
        found, rest = set(), sum(squares.values())
        bound = (threshold * threshold - 1e-9) * rest
        for term in sorted(squares, key=lambda t: (-squares[t], t)):
            if rest < bound:
                break
            found.add(term)
            rest -= squares[term]
        return found

    def best(self, line: str) -> tuple[float, str]:
        """Largest cosine and its template; the first by name of equal ones."""
        counts, products, square = Counter(terms(line)), {}, 0.0
        for term, n in counts.items():
            weight = n * self.idf.get(term, self.unseen)
            square += weight * weight
            for name, other in self.vectors.get(term, {}).items():
                products[name] = products.get(name, 0.0) + weight * other
        if not products:
            return 0.0, ""
        return min(((-p / (math.sqrt(square) * self.norms[name]), name) for name, p in products.items()))

    def scan(self, text: str) -> tuple[float, str | None, int]:
        """Cosine, template and number of the line nearest to a template; the first of equal lines. Lines that can't reach the
        threshold needn't be measured."""
        found: tuple[float, str | None, int] = (0.0, None, -1)
        telling = re.compile(self.pattern).search
        if not telling(text := text.lower()):
            return found
        for i, line in enumerate(text.split("\n")):
            if telling(line):
                minus, name = self.best(line)
                if -minus > found[0]:
                    found = (-minus, name, i)
        return found


def document_frequencies(rows: DataFrame, vocabulary: list[str]) -> tuple[int, dict[str, int]]:
    """Number of texts, and of texts with each term of the templates, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(frozenset(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, counts, n = shared.value, Counter(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += 1
                counts.update(wanted.intersection(terms(text or "")))
        yield pa.RecordBatch.from_arrays([pa.array([*counts, None], pa.string()), pa.array([*counts.values(), n], pa.int64())], ["term", "n"])

    found = rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in found}
    return counts.pop(None, 0), counts


def directory(path: Column) -> Column:
    """What stands before the last ``/``; empty for a file at the top."""
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def _ancestors(folder: Column) -> Column:
    """The directory itself and all above it, with their depths; the top is the empty string at depth 0."""
    parts = F.when(folder == "", F.array().cast("array<string>")).otherwise(F.split(folder, "/"))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.array_join(F.slice(parts, 1, i), "/").alias("ancestor"), i.alias("depth")))


def scan_licenses(files: DataFrame, templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  path_col: str = "path", text_col: str = "text", license_name: str = r"(?i)^(licen[cs]e|copying|notice)") -> DataFrame:
    """(doc_id, path, license, how, cosine, line, from_dir) for every file.

    ``own``: a line of the file is within ``threshold`` of a one-line notice, or a window of its terms (across lines, as
    long as the template) is near a title, header or full text, or, where no line is, near a notice. The nearest counts, of
    equal ones the longest template. ``inherited``: none is, and the nearest directory at or above the file that holds a licence file (by name, with a license of its own) gives its license.
    Else license and how are null. Of several licence files in a directory the nearest to its template counts, then
    the first template by name. ``line`` is where the notice or window begins. ``cosine`` is exact from the threshold on; below it, lines that can't reach it are not
    measured, and 0 stands for a file that has no others. Null texts have no line; files without a path inherit nothing. Repeated rows are
    scanned each; an empty table gives no rows. IDF weights are counted over all files.
    """
    rows = files.select(files[id_col].alias("doc_id"), files[path_col].alias("path"), files[text_col].alias("text"))
    forms = window_forms(templates)
    vocabulary = sorted({t for text in (*templates.values(), *(f.text for f in forms)) for t in terms(text)})
    n, counts = document_frequencies(rows, vocabulary)
    idf = {t: math.log((1 + n) / (1 + counts.get(t, 0))) + 1 for t in vocabulary}
    unseen = math.log(1 + n) + 1
    shared = rows.sparkSession.sparkContext.broadcast((Matcher(templates, idf, unseen, threshold), Windows(forms, terms, idf, unseen, threshold)))

    def nearest_of(text: str) -> tuple[float, str | None, int]:
        matcher, windows = shared.value
        line = matcher.scan(text)
        window = windows.scan(text, _TERM.finditer, with_notices=line[0] < threshold)
        # Equal cosines: all windows that meet a line near a template are of longer templates.
        return window if window[1] is not None and round(window[0], 9) >= round(line[0], 9) else line

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest_of(t or "") for t in batch.column(2).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.float64(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "path", "cosine", "name", "line"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scanned = written(rows.mapInArrow(run, f"doc_id {kind}, path string, cosine double, name string, line int"))
    own = F.col("cosine") >= threshold
    scanned = scanned.select("doc_id", "path", "cosine", F.when(own, F.col("name")).alias("own"), F.when(own, F.col("line")).alias("line"),
                             directory(F.col("path")).alias("dir"))
    base = F.regexp_extract("path", r"[^/]*$", 0)
    given = scanned.where(F.col("own").isNotNull() & base.rlike(license_name)).groupBy("dir").agg(
        F.min(F.struct((-F.col("cosine")).alias("c"), F.col("own").alias("name"))).alias("best"))
    given = given.select(F.col("dir").alias("ancestor"), F.col("best.name").alias("given"))
    # Directories, not files, meet the licence files, so that a directory of very many files is one row here.
    above = scanned.where("dir is not null").select("dir").distinct().select("dir", F.explode(_ancestors(F.col("dir"))).alias("a"))
    nearest = above.select("dir", "a.ancestor", "a.depth").join(given, "ancestor").groupBy("dir").agg(
        F.max(F.struct("depth", "ancestor", "given")).alias("near")).select("dir", "near.ancestor", "near.given")
    # Files without a path get keys of their own, so that they don't meet in one task.
    key = F.coalesce("dir", F.concat(F.lit("/"), F.xxhash64("doc_id").cast("string")))
    joined = scanned.withColumn("dir", key).join(nearest, "dir", "left")
    how = F.when(F.col("own").isNotNull(), "own").when(F.col("given").isNotNull(), "inherited")
    return joined.select("doc_id", "path", F.coalesce("own", "given").alias("license"), how.alias("how"), "cosine", "line",
                         F.when(F.col("own").isNull(), F.col("ancestor")).alias("from_dir"))
