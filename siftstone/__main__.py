"""python -m siftstone SPEC [--out FOLDER] [--protected FOLDER]: the texts of a specification document.

Exit codes: 0 written, 2 the document is invalid or the folder is protected.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftstone.operators import specs
from siftstone.sources import readers, sinks


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="siftstone", description="Expand a specification document into its prompt and narration files.")
    p.add_argument("spec", help="a JSON document")
    p.add_argument("--out", help="folder to write to (default: out/PACKAGE)")
    p.add_argument("--protected", help="a folder that must not be written to")
    args = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("siftstone").getOrCreate()
    try:
        documents = specs.violations(specs.parse_specs(readers.read_specs(spark, args.spec)))
        found = documents.select("errors", "spec.package", F.coalesce("spec.structure", F.lit("5")).alias("structure")).collect()  # one row: the document
    except Exception as e:
        print(f"cannot read {args.spec}: {str(e).splitlines()[0]}", file=sys.stderr)
        return 2
    wrong = [e for r in found for e in r.errors]
    if wrong or len(found) != 1:
        print(f"{args.spec}: {', '.join(wrong) or 'not one document'}", file=sys.stderr)
        return 2
    document = found[0]
    shots = specs.expand(documents, spark)
    try:
        written = sinks.write_package(specs.render(shots), args.out or f"out/{document.package}", args.protected)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    for r in shots.orderBy("pos").select("shot_id", F.array_join("shot.line", "｜").alias("line")).collect():  # five shots at most
        print(document.package, r.shot_id, r.line)
    print(f"{written} files written")
    length = specs.TIMING[document.structure][2]
    if length != specs.TIMING["5"][2]:
        print(f"structure {document.structure}: clips need --length {length}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
