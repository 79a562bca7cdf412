"""Word-overlap and link-graph analytics on PySpark DataFrames.

Public API (every function maps DataFrames to DataFrames):

* sources: ``edge_list``, ``url_pairs``, ``bag_files``, ``bags_from_rows``,
  ``counts_from_rows``, ``bags_from_text``, ``bags_from_events``
* sinks: ``write_tuples``, ``write_table``
* graph: ``Graph``, ``vertices_of``, ``out_degrees``, ``degrees``,
  ``with_degrees``, ``edge_weights``, ``triplets``, ``update_join``,
  ``map_triplets``, ``aggregate_neighbors``, ``aggregate_messages``,
  ``adjacency``, ``adjacency_lists``
* overlap: ``bag_sizes``, ``overlap_edges``, ``overlap_graph``
* iterative: ``pagerank``, ``components_from_postings``,
  ``components_from_edges``, ``component_sizes``
* placement: ``place``, ``placement_report``, ``placement_summary``
* questions: ``larger_source_edges``, ``most_popular_vertex``,
  ``neighbor_average``, ``tied_vertices``, ``most_popular_word``, ``word_presence``,
  ``largest_component``
* streaming: ``interval_counts_stream``
* session: ``checkpoint_dir``, ``release_cuts``
"""

from wordgraph.operators.components import (
    component_sizes,
    components_from_edges,
    components_from_postings,
)
from wordgraph.operators.graph import (
    Graph,
    adjacency,
    adjacency_lists,
    adjacency_targets,
    aggregate_messages,
    aggregate_neighbors,
    degrees,
    edge_weights,
    in_degrees,
    map_triplets,
    out_degrees,
    triplets,
    update_join,
    vertices_of,
    with_degrees,
)
from wordgraph.operators.overlap import bag_sizes, larger_source_count, neighbor_totals, overlap_edges, overlap_graph
from wordgraph.operators.pagerank import pagerank
from wordgraph.operators.placement import place, placement_report, placement_summary
from wordgraph.plans.questions import (
    largest_component,
    larger_source_edges,
    most_popular_vertex,
    most_popular_word,
    neighbor_average,
    tied_vertices,
    word_presence,
    word_totals,
)
from wordgraph.sources.sinks import write_table, write_tuples
from wordgraph.sources.tables import (
    bags_from_events,
    bags_from_rows,
    bags_from_text,
    counts_from_rows,
)
from wordgraph.sources.text import bag_files, edge_list, url_pairs
from wordgraph.session import checkpoint_dir, release_cuts
