import pytest

NAMES = ["entity_id", "business_name", "business_address", "country"]

SOURCES = {
    1: [
        ("S1-00001", "Memorial Society LLC", "3807 Lamar Avenue, Memphis, TN", "US"),
        ("S1-00002", "Urban Pacific Launchpad", "12 Elm Rd, Austin", "US"),
        ("S1-00003", "राम ट्रेडिंग प्राइवेट लिमिटेड", "Plot 7, MG Road, Pune", "India"),
        ("S1-00004", "Café Déntal", "5 Rue Haute, Lyon", "France"),
        ("S1-00005", "Solo Works", "", "US"),
    ],
    2: [
        ("S2-00001", "The Memorial Society", "TN, MEMPHIS, 03807 LAMAR AVE", "US"),
        ("S2-00002", "urbanpacificlaunchpad.com", "12b Elm Road", "US"),
        ("S2-00003", "Ram Trading Pvt Ltd", "M G Rd, Plot 07, Pune", "India"),
    ],
    3: [
        ("S3-00001", "cafe dental", "Lyon, 5 rue haute", "France"),
        ("S3-00002", "Mem0rial S0ciety Inc", "", "US"),
        ("S3-00003", "Memorial Society", "3807 Lamar Ave", "USA"),
    ],
}


@pytest.fixture(scope="session")
def source_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("sources")
    paths = {}
    for src, rows in SOURCES.items():
        path = folder / f"source{src}.tsv"
        path.write_text("\n".join("\t".join(r) for r in [tuple(NAMES), *rows]) + "\n", encoding="utf-8")
        paths[src] = str(path)
    return paths
