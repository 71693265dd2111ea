"""python -m gleaner COMMAND: the pipeline's stages over files. Ends with 0, 1 (failed or empty) or 2 (refused)."""

from __future__ import annotations

import argparse
import importlib
import sys
import time

from pyspark.sql import functions as F

from gleaner import reports, vocab
from gleaner.config import Settings
from gleaner.operators import evaluation as evl
from gleaner.operators import evidence as ev
from gleaner.operators import extraction as ex
from gleaner.operators import publish as pb
from gleaner.operators import ratings as rt
from gleaner.operators import selection as sel
from gleaner.runtime import materialise, release, session
from gleaner.sources import jsonl, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gleaner")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in {
        "select": ("shards", "out"), "extract": ("candidates", "folder"), "aggregate": ("claims", "out"), "ratings": ("reviews", "out"), "evaluate": ("gold", "results"), "report": ("verdicts",),
        "reviews": ("reviews", "places", "out"), "place": ("claims", "documents", "branches", "out"), "site": ("claims", "out"), "detail": ("claims", "store"),
    }.items():
        c = sub.add_parser(name)
        for a in args:
            c.add_argument(a)
        c.add_argument("--now", type=int, default=Settings.now)
        c.add_argument("--subreddits", nargs="*")
        c.add_argument("--limit", type=int)
        c.add_argument("--least", type=float, default=0.0)
        c.add_argument("--provider", help="module:name of what makes a provider; without it word lists decide")
    return p


def provider_of(name: str | None) -> ex.Provider:
    if not name:
        return ex.WordProvider()
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark, s = session(), Settings(now=args.now)
    try:
        if args.command == "select":
            raw = sel.resolve_parents(jsonl.read_shards(spark, args.shards, args.subreddits))
            docs = raw.withColumns(
                {"text": sel.document_text(F.col("body"), F.col("title"), F.col("selftext")), "permalink": sel.permalink(F.col("kind"), F.col("subreddit"), F.col("id"), F.col("link_id"), F.col("permalink"))}
            )
            kept = sel.select_candidates(docs, ["shard", "ord"], s, args.limit)
            sinks.publish(kept.select(*[c.split()[0] for c in jsonl.CANDIDATE.split(", ")]), args.out, fmt="json")
        elif args.command == "extract":
            documents, _ = jsonl.read_candidates(spark, args.candidates)
            with sinks.single_writer(spark, args.folder):
                done = ex.run_extraction(documents, args.folder, provider_of(args.provider), progress=ex.progress_lines())
            print(done)
            return 1 if done.stopped else 0
        elif args.command == "aggregate":
            claims, dropped = jsonl.read_claims(spark, args.claims, s)
            print("dropped", dropped.first()[0])
            weighed = materialise(ev.weigh(ev.prepare(ev.valid_claims(claims, s), s), s), "weighed")
            cells = ev.branch_cells(weighed)
            chains = ev.chain_cells(cells)
            for name, table in {"branches": cells, "stores": chains, "items": ev.item_cells(weighed), "totals": ev.store_totals(chains), "branch_totals": ev.branch_totals(cells)}.items():
                sinks.publish(ev.view(table, s), f"{args.out}/{name}", check=True, allow_empty=name != "stores")
        elif args.command == "ratings":
            rows = jsonl.read_reviews(spark, args.reviews)
            sinks.publish(rt.summarise(rt.usable_reviews(rows), ["store"], s), f"{args.out}/stores", check=True)
            sinks.publish(rt.summarise(rt.usable_reviews(rows), ["gmap_id"], s), f"{args.out}/places", check=True)
        elif args.command == "reviews":
            stores = spark.read.schema("gmap_id string, store string").json(args.places).where("gmap_id is not null and store is not null").dropDuplicates(["gmap_id"])
            sinks.publish(sel.review_candidates(jsonl.read_review_texts(spark, args.reviews), stores, s), args.out, fmt="json")
        elif args.command == "place":
            claims, _ = jsonl.read_claims(spark, args.claims, s)
            documents = spark.read.schema("source_id string, place string, reviewed string").json(args.documents).dropDuplicates(["source_id"])
            branches = spark.read.schema("place string, branch string").json(args.branches).dropDuplicates(["place"])
            placed = materialise(sel.attach_place(claims, documents, branches), "placed")
            sinks.publish(placed.drop("foreign", "claim_row"), args.out, fmt="json")
            print(pb.placement(placed).first().asDict())
        elif args.command in ("site", "detail"):
            claims, _ = jsonl.read_claims(spark, args.claims, s)
            weighed = materialise(ev.weigh(ev.prepare(ev.valid_claims(claims, s), s), s), "weighed")
            if args.command == "detail":
                print("\n".join(reports.detail_lines(weighed.where(F.col("store") == args.store), args.store, s)))
                return 0
            head = {
                "generated_at": time.strftime("%Y-%m-%d", time.gmtime(args.now)), "method": {"shrinkage": s.shrinkage, "default_half_life_years": s.default_half_life}, "places": [],
                "keywords": {w: c for c, words in vocab.LIST_WORDS.items() for w in words}, "receipts": {"words": vocab.RECEIPT_WORDS, "units": list(vocab.RECEIPT_UNITS), "brands": list(vocab.RECEIPT_BRANDS)},
            }
            print(pb.write_sections(spark, materialise(pb.verdict_sections(weighed, s), "sections"), head, args.out), "bytes")
        elif args.command == "evaluate":
            gold = jsonl.read_gold(spark, args.gold)
            cases = gold.select(F.col("id").alias("case"), F.lit("gold").alias("subreddit"), F.lit("comments").alias("kind"), "id", "text", "parent_body", "stores")
            claims = ex.extract(cases, provider_of(args.provider)).where("status = 'ok'").select(F.regexp_extract("key", "_gold_(.*)$", 1).alias("case"), F.posexplode(F.from_json("payload", ex.CLAIMS)).alias("ord", "c"))
            score = materialise(evl.score(evl.compare(cases.select("case"), evl.expected_claims(gold), claims.select("case", "ord", "c.*"))), "score")
            score.coalesce(1).write.mode("overwrite").json(args.results)
            print("\n".join(reports.score_lines(score)))
            return 0 if (score.first()["exact_match"] or 0.0) >= args.least else 1
        else:
            print("\n".join(reports.totals_lines(spark.read.parquet(f"{args.verdicts}/totals"))))
    except (sinks.EmptyResultError, pb.PublishingError) as e:
        print(e, file=sys.stderr)
        return 1
    except (FileNotFoundError, sinks.LockedError) as e:
        print(e, file=sys.stderr)
        return 2
    finally:
        release(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
