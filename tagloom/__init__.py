"""Social-text analytics on Spark: posts to tables, word pairs, hashtag networks."""

from tagloom.functions.text import clean_text, tokens, words
from tagloom.operators.batching import assign_batches, batches_of, max_batch_index
from tagloom.operators.checks import (
    check_hashtags,
    check_tweets,
    mark_duplicates,
    orphan_hashtags,
    split_checked,
    split_duplicates,
)
from tagloom.operators.hashtags import (
    cooccurrence,
    fetch_hashtags,
    hashtag_pairs,
    hashtag_sets,
    multi_hashtag,
    set_pairs,
)
from tagloom.operators.merge import merge_add, merge_add_stored, read_totals, total
from tagloom.operators.network import network_edges, network_vertices
from tagloom.operators.pairs import (
    count_pairs,
    endpoint_pairs,
    literal_overflow,
    plain_counts,
)
from tagloom.operators.status import release_batch, set_status, upsert_batches
from tagloom.operators.units import distinct_units, keyed_units, lemmatise, units, with_words
from tagloom.operators.unpack import unpack_hashtags, unpack_tweets
from tagloom.plans.hashtag_network import hashtag_network, rebuild_network
from tagloom.plans.ingest import split_ingest, stored_ids, write_ingest
from tagloom.plans.word_pairs import unit_pairs, word_pairs
from tagloom.sources.tables import (
    batch_states,
    batch_text,
    new_batches,
    read_cooccurrence,
    read_ingested,
    release_stored_batch,
    reset_tables,
    set_stored_status,
    table_exists,
    visible_loads,
)
from tagloom.sources.tweets import broken_files, read_tweets, stream_tweets
from tagloom.streaming.jobs import (
    batch_status,
    compact_cooccurrence,
    compact_pairs,
    cooccurrence_totals,
    pair_totals,
    run_cooccurrence,
    run_word_pairs,
    running_pairs,
)

__all__ = [name for name in dir() if not name.startswith("_")]
