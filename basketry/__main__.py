"""``python -m basketry <job> ...``: run one file-to-file job on the current Spark session."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="basketry")
    sub = p.add_subparsers(dest="job", required=True)

    f = sub.add_parser("feature", help="P1 feature generation")
    for a in ("useraction_dir", "metadata_dir", "action"):
        f.add_argument(a)
    f.add_argument("prod_threshold", type=int)
    for a in ("start_date", "end_date", "output_dir"):
        f.add_argument(a)

    s = sub.add_parser("sort", help="P2 sort the log by a column")
    for a in ("useraction_dir", "column", "output_dir"):
        s.add_argument(a)

    g = sub.add_parser("aggregate", help="P3 behaviour aggregation")
    g.add_argument("feature_dir")
    g.add_argument("output")
    g.add_argument("--single-file", action="store_true")

    i = sub.add_parser("instances", help="P4 instance building")
    i.add_argument("orders_path")
    i.add_argument("output_dir")
    for a in ("--blacklist-path", "--clicks-path", "--categories-path", "--embedding-dir", "--titles-dir"):
        i.add_argument(a)
    i.add_argument("--version", default="6w")
    i.add_argument("--strict", action="store_true", help="fail on an item without a vector")
    for a, d in (("--item-cut", 1), ("--min-orders", 4), ("--max-orders", 8), ("--max-clicks", 16)):
        i.add_argument(a, type=int, default=d)

    t = sub.add_parser("titles", help="P6 title vectors")
    t.add_argument("product_path")
    t.add_argument("output_dir")
    t.add_argument("--vector-size", type=int, default=64)
    t.add_argument("--learned", action="store_true", help="token vectors from co-occurrences instead of hashes")
    t.add_argument("--window", type=int, default=2, help="of the learned model")

    e = sub.add_parser("evaluate", help="P7 recommend and evaluate")
    e.add_argument("data_dir")
    e.add_argument("output_dir")
    e.add_argument("--algorithm", default="last")
    e.add_argument("--top-k", type=int, default=10)
    e.add_argument("--pos-cases", type=int, help="at most so many hits (default: all)")
    e.add_argument("--neg-cases", type=int, help="at most so many misses (default: all)")

    m = sub.add_parser("metadata", help="P5 metadata preparation")
    m.add_argument("output_dir")
    for e in ("user", "comp_mid", "product", "category", "deal_item", "prod_category"):
        m.add_argument(f"--{e.replace('_', '-')}", dest=e, help=f"raw {e} CSV")
    m.add_argument("--search-words-path")
    m.add_argument("--valid-products-path")
    m.add_argument("--prepared-product-path")
    m.add_argument("--which", nargs="*", default=[])
    m.add_argument("--seed", type=int, default=0)
    m.add_argument("--jdbc-url")
    m.add_argument("--single-file", action="store_true")
    m.add_argument("--extend", action="store_true", help="codes for members that the given mapping lacks")

    o = sub.add_parser("orders", help="P8 order rows of the log")
    o.add_argument("useraction_dir")
    o.add_argument("output")
    o.add_argument("--min-bytes", type=int, help="only parts larger than this")
    o.add_argument("--max-bytes", type=int, help="only parts of at most this size")

    w = sub.add_parser("search_words", help="P8 distinct search keywords")
    w.add_argument("useraction_dir")
    w.add_argument("output")

    args = vars(p.parse_args(argv))
    job = args.pop("job")
    if job == "metadata":
        entities = ("user", "comp_mid", "product", "category", "deal_item", "prod_category")
        args["sources"] = {e: args.pop(e) for e in entities if args.get(e)}
        for e in entities:
            args.pop(e, None)
        args["which"] = tuple(args["which"])
    spark = SparkSession.builder.appName(f"basketry-{job}").getOrCreate()
    getattr(jobs, f"{job}_job")(spark, **args)


if __name__ == "__main__":
    main()
