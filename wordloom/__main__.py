"""``python -m wordloom INPUT OUTPUT``: the whole job on text files or a Parquet table."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession

from wordloom.operators import bpe, lines
from wordloom.plans.pipeline import Settings, export_text, run
from wordloom.sources import readers

PATTERNS = {"50k": bpe.WORDS_50K, "100k": bpe.WORDS_100K}


def main(arguments: list[str] | None = None) -> dict[str, str]:
    parser = argparse.ArgumentParser(prog="wordloom", description=__doc__)
    parser.add_argument("input", help="text file or folder, or a Parquet table with doc_id and text (--table)")
    parser.add_argument("output", help="folder for the tables")
    parser.add_argument("--table", action="store_true", help="read a Parquet table")
    parser.add_argument("--prefix", default="", help="read only files whose names start so")
    parser.add_argument("--ranks", help="rank table file; a dictionary of the corpus is used without one")
    parser.add_argument("--words", choices=PATTERNS, default="100k", help="how the rank table cuts words")
    parser.add_argument("--text", action="store_true", help="write the results as text as well")
    parser.add_argument("--single-file", action="store_true", help="write each text as one file")
    for field in dataclasses.fields(Settings):
        flag = "--" + field.name.replace("_", "-")
        if isinstance(field.default, bool):
            parser.add_argument(flag, action=argparse.BooleanOptionalAction, default=field.default)
        else:
            parser.add_argument(flag, type=type(field.default), default=field.default, help=f"default {field.default!r}")
    given = parser.parse_args(arguments)
    settings = Settings(**{f.name: getattr(given, f.name) for f in dataclasses.fields(Settings)})

    spark = SparkSession.builder.appName("wordloom").getOrCreate()
    if given.table:
        source = lines.to_lines(readers.table(spark, given.input, "doc_id", "text"))
    else:
        source = readers.text_files_with_offset(spark, given.input, given.prefix)
    encoder = bpe.Encoder(bpe.read_ranks(spark, given.ranks), PATTERNS[given.words]) if given.ranks else None
    written = run(source, given.output, settings, encoder)
    if given.text:
        texts = export_text(spark, written, f"{given.output}/text", given.single_file)
        written |= {f"text/{name}": path for name, path in texts.items()}
    for name, path in written.items():
        print(f"{name}: {path}")
    return written


if __name__ == "__main__":
    main()
