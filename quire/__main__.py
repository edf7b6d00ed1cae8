"""``python -m quire INPUT [OUTPUT]``: transcripts (or PDFs) to HTML files."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .errors import ConversionError, ReaderUnavailable
from .functions.words import dictionary, no_words
from .plans.convert import convert
from .plans.document import inline_sink, parse_documents
from .sources import pdf, reader, sinks, transcripts


def main(argv: list[str] | None = None) -> int:
    """0 when written, 1 with a message for a failure that has a name."""
    parser = argparse.ArgumentParser(prog="quire", description="Convert page transcripts or PDFs to self-contained HTML.")
    parser.add_argument("input", type=Path)
    parser.add_argument("output", type=Path, nargs="?", help="default: the input with the suffix .html")
    parser.add_argument("--reader-url", help="root of the page reader's interface")
    parser.add_argument("--reader-model")
    parser.add_argument("--image-dir", type=Path, help="write figures there instead of into the HTML")
    parser.add_argument("--words", type=Path, help="a word list, one a line, that decides on hyphens at line ends (default: /usr/share/dict/words, if there)")
    args = parser.parse_args(argv)
    if not args.input.is_file():
        parser.error(f"not found: {args.input}")
    output = args.output or args.input.with_suffix(".html")
    # one document: its figures go to the folder itself
    folder = sinks.folder_sink(args.image_dir.resolve().as_uri()) if args.image_dir else None
    sink = (lambda data, mime, number: folder(data, mime, number)) if folder else inline_sink
    words = args.words or Path("/usr/share/dict/words")
    known = dictionary(words.read_text(encoding="utf-8").split()) if words.is_file() else no_words
    spark = SparkSession.builder.master("local[*]").config("spark.ui.enabled", "false").getOrCreate()
    try:
        if args.input.suffix.lower() == ".pdf":
            pdf.library()
            pdf.register(spark)
            url, model = args.reader_url, args.reader_model
            reader.Reader.connect(url, model)
            path = args.input.resolve().as_uri()
            source = spark.read.format(pdf.NAME).option("skipcovers", "true").load(path)
            documents, failures = convert(source, lambda: reader.Reader.connect(url, model), known, sink=sink, region=pdf.Regions(path))
            if failed := failures.first():
                raise ReaderUnavailable(failed["error"]) if failed["disposition"] == "retry" else ConversionError(failed["error"])
        else:
            documents = parse_documents(transcripts.read_transcripts(spark, args.input.resolve().as_uri()), known, sink=sink)
        done = documents.first()
    except ConversionError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    output.write_text(done["html"] if done else "", encoding="utf-8")
    print(f"wrote {output}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
