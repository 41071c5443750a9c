"""Record layouts, enumerations and the defaults that differ by place of use."""

from __future__ import annotations

SLICE = "id STRING, `order` INT, source_file STRING, slug STRING, text STRING, slice_token_start INT, slice_token_end INT"
CONCEPT = "_ord BIGINT, concept_id STRING, term STRUCT<primary: STRING, aliases: ARRAY<STRING>>, definition STRING"
NODE = "_ord BIGINT, id STRING, type STRING, text STRING, node_offset INT, definition STRING, concepts ARRAY<STRING>, difficulty INT, tags ARRAY<STRING>, language STRING, metadata STRING"
EDGE = "_ord BIGINT, source STRING, target STRING, type STRING, weight DOUBLE, conditions STRING"
#: One document of a graph or a dictionary, as JSON.
GRAPH_JSON = "_meta STRING, nodes ARRAY<STRUCT<id: STRING, type: STRING, text: STRING, node_offset: INT, definition: STRING, concepts: ARRAY<STRING>, difficulty: INT, tags: ARRAY<STRING>, language: STRING, metadata: STRING>>, edges ARRAY<STRUCT<source: STRING, target: STRING, type: STRING, weight: DOUBLE, conditions: STRING>>"
DICTIONARY_JSON = "_meta STRING, concepts ARRAY<STRUCT<concept_id: STRING, term: STRUCT<primary: STRING, aliases: ARRAY<STRING>>, definition: STRING>>"

# The data model's enumerations.
NODE_TYPES = ("Chunk", "Concept", "Assessment")
EDGE_TYPES = ("PREREQUISITE", "ELABORATES", "EXAMPLE_OF", "HINT_FORWARD", "REFER_BACK", "PARALLEL", "TESTS", "REVISION_OF", "MENTIONS")
EDUCATIONAL = ("PREREQUISITE", "ELABORATES", "EXAMPLE_OF", "TESTS")
STRONG = ("PREREQUISITE", "TESTS")
MEDIUM = ("ELABORATES", "EXAMPLE_OF", "PARALLEL", "REVISION_OF")
WEAK = ("HINT_FORWARD", "REFER_BACK", "MENTIONS")
ID_PATTERN = "^[A-Za-z0-9:_-]+$"
#: Defaults of a missing weight: in metrics, where edges are merged, in what is shown.
WEIGHT_METRICS, WEIGHT_MERGE, WEIGHT_SHOWN = 1.0, 0.5, 0.5
DIFFICULTY = 3
NODE_METRICS = ("degree_in", "degree_out", "degree_centrality", "pagerank", "betweenness_centrality", "out-closeness", "component_id", "prerequisite_depth", "learning_effort", "educational_importance")
