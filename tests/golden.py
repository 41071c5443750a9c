"""Small graphs with their expected metrics (fixed values): nodes id[type,difficulty], edges source>target:TYPE:weight, and
rows id in out deg_c pagerank betweenness out-closeness component depth effort importance."""

GRAPHS = {
    "bridge": (
        "A[Chunk,2] B[Chunk,2] C[Chunk,3] D[Chunk,3] E[Chunk,3] F[Chunk,2] G[Chunk,2]",
        "A>B:PARALLEL:1.0 B>C:PREREQUISITE:1.0 C>A:REFER_BACK:1.0 C>D:PREREQUISITE:1.0 D>E:PREREQUISITE:1.0 E>F:PARALLEL:1.0 F>G:PREREQUISITE:1.0 G>E:REFER_BACK:1.0 A>C:ELABORATES:1.0 E>G:ELABORATES:1.0",
        """A 1 2 0.500000 0.057488 0.033333 0.400000 0 0 2.0 0.055940
        B 1 1 0.333333 0.045861 0.000000 0.375000 0 0 2.0 0.055940
        C 2 2 0.666667 0.084844 0.300000 0.500000 0 1 5.0 0.151037
        D 1 1 0.333333 0.057488 0.300000 0.300000 0 2 8.0 0.184321
        E 2 2 0.666667 0.313511 0.300000 0.333333 0 3 11.0 0.212614
        F 1 1 0.333333 0.154670 0.000000 0.222222 0 0 2.0 0.055940
        G 2 1 0.500000 0.286139 0.033333 0.222222 0 1 4.0 0.284208""",
    ),
    "cycle": (
        "a[Chunk,2] b[Chunk,2] c[Chunk,2] d[Chunk,2]",
        "a>b:PREREQUISITE:1.0 b>c:PREREQUISITE:1.0 c>d:PREREQUISITE:1.0 d>a:PREREQUISITE:1.0",
        "\n".join(f"{v} 1 1 0.666667 0.250000 0.500000 0.500000 0 0 8.0 0.250000" for v in "abcd"),
    ),
    "disconnected": (
        "A[Chunk,1] B[Chunk,2] C[Chunk,3] D[Chunk,2] E[Chunk,2]",
        "A>B:PREREQUISITE:1.0 B>C:PREREQUISITE:1.0 D>E:ELABORATES:1.0",
        """A 0 1 0.250000 0.120882 0.000000 0.333333 0 0 1.0 0.120882
        B 1 1 0.500000 0.223633 0.083333 0.250000 0 1 3.0 0.223633
        C 1 0 0.250000 0.310970 0.000000 0.000000 0 2 6.0 0.310970
        D 0 1 0.250000 0.120882 0.000000 0.250000 1 0 2.0 0.120882
        E 1 0 0.250000 0.223633 0.000000 0.000000 1 0 2.0 0.223633""",
    ),
    "educational": (
        "concept_1[Concept,1] chunk_1[Chunk,2] chunk_2[Chunk,3] assessment_1[Assessment,3]",
        "concept_1>chunk_1:PREREQUISITE:1.0 chunk_1>chunk_2:PREREQUISITE:1.0 chunk_1>concept_1:EXAMPLE_OF:1.0 chunk_2>chunk_1:ELABORATES:1.0 assessment_1>chunk_2:TESTS:1.0",
        """concept_1 1 1 0.666667 0.234062 0.000000 0.444444 0 0 1.0 0.234062
        chunk_1 2 2 1.333333 0.462500 0.500000 0.666667 0 1 3.0 0.462500
        chunk_2 2 1 1.000000 0.265937 0.333333 0.444444 0 2 6.0 0.265937
        assessment_1 0 1 0.333333 0.037500 0.000000 0.500000 0 0 3.0 0.037500""",
    ),
    "line": (
        "a[Chunk,1] b[Chunk,2] c[Chunk,3] d[Chunk,4]",
        "a>b:PREREQUISITE:1.0 b>c:PREREQUISITE:1.0 c>d:PREREQUISITE:1.0",
        """a 0 1 0.333333 0.116156 0.000000 0.500000 0 0 1.0 0.116156
        b 1 1 0.666667 0.214888 0.333333 0.444444 0 1 3.0 0.214888
        c 1 1 0.666667 0.298811 0.333333 0.333333 0 2 6.0 0.298811
        d 1 0 0.333333 0.370146 0.000000 0.000000 0 3 10.0 0.370146""",
    ),
    "realistic": (
        "chunk_intro[Chunk,1] concept_complexity[Concept,-] chunk_sorting[Chunk,2] chunk_bubble[Chunk,2] concept_sorting[Concept,-] chunk_quicksort[Chunk,3] concept_recursion[Concept,-] assessment_sorting[Assessment,3] chunk_optimization[Chunk,4] assessment_final[Assessment,4]",
        "chunk_intro>concept_complexity:MENTIONS:0.35 chunk_intro>chunk_sorting:PREREQUISITE:0.9 concept_complexity>chunk_sorting:PREREQUISITE:0.85 chunk_sorting>concept_sorting:MENTIONS:0.4 chunk_sorting>chunk_bubble:PREREQUISITE:0.85 chunk_bubble>chunk_quicksort:PARALLEL:0.6 concept_sorting>chunk_bubble:ELABORATES:0.65 concept_sorting>chunk_quicksort:ELABORATES:0.7 chunk_quicksort>concept_recursion:MENTIONS:0.35 assessment_sorting>chunk_bubble:TESTS:0.9 assessment_sorting>chunk_quicksort:TESTS:0.9 chunk_quicksort>chunk_optimization:PREREQUISITE:0.95 chunk_optimization>chunk_quicksort:REVISION_OF:0.85 concept_recursion>chunk_optimization:PREREQUISITE:0.8 assessment_final>chunk_optimization:TESTS:0.85 chunk_sorting>assessment_final:HINT_FORWARD:0.4",
        """chunk_intro 0 2 0.222222 0.015000 0.000000 0.244947 0 0 1.0 0.052685
        concept_complexity 1 1 0.222222 0.018570 0.000000 0.204435 0 0 3.0 0.052685
        chunk_sorting 2 3 0.555556 0.039965 0.166667 0.217434 0 1 5.0 0.142249
        chunk_bubble 3 1 0.444444 0.048384 0.083333 0.112236 0 2 7.0 0.217547
        concept_sorting 1 2 0.333333 0.023235 0.000000 0.182637 0 0 3.0 0.052685
        chunk_quicksort 4 2 0.666667 0.368843 0.152778 0.113675 0 0 3.0 0.098296
        concept_recursion 1 1 0.222222 0.099409 0.000000 0.120889 0 0 3.0 0.052685
        assessment_sorting 0 2 0.222222 0.015000 0.000000 0.212800 0 0 3.0 0.052685
        chunk_optimization 3 1 0.444444 0.348359 0.041667 0.085305 0 1 7.0 0.225799
        assessment_final 1 1 0.222222 0.023235 0.041667 0.114423 0 0 4.0 0.052685""",
    ),
    "star": (
        "central[Concept,2] branch_1[Chunk,1] branch_2[Chunk,3] branch_3[Chunk,3] branch_4[Assessment,4]",
        "central>branch_1:EXAMPLE_OF:1.0 central>branch_2:EXAMPLE_OF:1.0 central>branch_3:EXAMPLE_OF:1.0 central>branch_4:TESTS:1.0",
        """central 0 4 1.000000 0.170940 0.000000 1.000000 0 0 2.0 0.170940
        branch_1 1 0 0.250000 0.207265 0.000000 0.000000 0 0 1.0 0.207265
        branch_2 1 0 0.250000 0.207265 0.000000 0.000000 0 0 3.0 0.207265
        branch_3 1 0 0.250000 0.207265 0.000000 0.000000 0 0 3.0 0.207265
        branch_4 1 0 0.250000 0.207265 0.000000 0.000000 0 0 4.0 0.207265""",
    ),
    "weighted_triangle": (
        "A[Chunk,1] B[Chunk,3] C[Chunk,2]",
        "A>B:PREREQUISITE:0.9 B>C:EXAMPLE_OF:0.3 C>A:ELABORATES:0.6",
        """A 1 1 1.000000 0.333333 0.500000 0.360000 0 0 1.0 0.333333
        B 1 1 1.000000 0.333333 0.500000 0.240000 0 1 4.0 0.333333
        C 1 1 1.000000 0.333333 0.500000 0.450000 0 0 2.0 0.333333""",
    ),
}


def parsed(name):
    nodes, edges, rows = GRAPHS[name]
    n = [(x.split("[")[0], *((t := x[x.index("[") + 1 : -1].split(","))[0], None if t[1] == "-" else int(t[1]))) for x in nodes.split()]
    e = []
    for x in edges.split():
        pair, kind, w = x.split(":")
        e.append((*pair.split(">"), kind, float(w)))
    return n, e, {r.split()[0]: [float(v) for v in r.split()[1:]] for r in rows.strip().split("\n")}
