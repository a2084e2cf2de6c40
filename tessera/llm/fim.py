"""Fill-in-the-middle: documents cut at token borders and put together anew around three marks.

A text is n tokens: runs of A-Z and a-z, and every other code point by itself. Four numbers from a sha256 of the seed and the id
decide whether a document stays plain, where its middle lies and which order its parts take:

* psm: `<P>`prefix`<S>`suffix`<M>`middle
* spm: `<S>`suffix`<P>`prefix`<M>`middle
* plain: the text itself, also where it is empty or holds one of the marks, so that every output can be taken apart again.

Each Arrow batch is registered in a DuckDB connection of the Python worker and goes through one SQL statement; rows never become
Python objects. There is no shuffle and no state between batches, so a lost task is simply run again.

Defined cases: a null text counts as an empty one; a null id is hashed as the word null; repeated rows give equal results; texts of
any length are cut whole (a batch holds BATCH_BYTES of text or one row, and about 30 bytes a token while it is cut); other columns are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import modest

SEED = 1
#: Of a hundred documents, those that stay plain, and of the others those with the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20

_SQL = """
WITH hashed AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS units, sha256('{seed}:' || id) AS h FROM batch),
drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
    ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS a, ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= {plain} THEN 'plain'
      WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < {first} THEN 'spm' ELSE 'psm' END AS form
  FROM hashed),
parts AS (
  SELECT doc_id, text, n, form,
    CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, 1, least(a, b)), '') END AS prefix,
    CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, least(a, b) + 1, greatest(a, b)), '') END AS middle,
    CASE WHEN form <> 'plain' THEN array_to_string(list_slice(units, greatest(a, b) + 1, n), '') END AS suffix
  FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, length(prefix)::BIGINT AS prefix_chars, length(middle)::BIGINT AS middle_chars,
  CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END AS output
FROM parts"""

_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])


def _cutter(sql: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        with duckdb.connect(config={"threads": 1}) as db:
            for batch in batches:
                db.register("batch", pa.Table.from_batches([batch]))
                got = db.sql(sql).to_arrow_table()
                db.unregister("batch")
                yield from got.cast(_SCHEMA).to_batches()
                del got
                pa.default_memory_pool().release_unused()

    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of ``docs``; lengths are code points and null for plain rows."""
    modest(docs.sparkSession)
    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id.cast("string"), F.lit("null")).alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    sql = _SQL.format(seed=int(seed), plain=100 - int(plain), first=int(suffix_first))
    return rows.mapInArrow(_cutter(sql), "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The marks stand once each in psm and spm outputs, since texts that hold one stay plain."""
    part = F.split(output, "<[PSM]>", -1)
    at = lambda i: F.get(part, F.lit(i))
    return F.when(form == "psm", F.concat(at(1), at(3), at(2))).when(form == "spm", F.concat(at(2), at(3), at(1))).otherwise(output)
