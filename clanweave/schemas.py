"""Schemas of the base tables and the catalogue of node attributes (fixed values)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TAXON_RANKS = ["Domain", "Kingdom", "Phylum", "Class", "TaxOrder", "Family", "Genus"]

_MATCH = "id string, accession string, start int, end int"
BASE_TABLES: dict[str, str] = {
    "annotations": (
        "accession string, Uniprot_ID string, STATUS string, Sequence_Length int, Taxonomy_ID int, GDNA string, Description string, "
        "SwissProt_Description string, Organism string, GN string, pdb string, GO string, KEGG string, STRING string, BRENDA string, "
        "PATRIC string, HMP_Body_Site string, HMP_Oxygen string, Target_ID string, EC string, Cazy string, Fragment int, Ref_Proteome string"
    ),
    "taxonomy": "Taxonomy_ID int, " + ", ".join(f"{r} string" for r in TAXON_RANKS) + ", Species string",
    "PFAM": _MATCH,
    "GENE3D": _MATCH,
    "SSF": _MATCH,
    "TIGRFAMs": _MATCH,
    "INTERPRO": _MATCH + ", family_type string, parent string, is_leaf int",
    "uniref": "accession string, uniref50_seed string, uniref90_seed string",
    "family_info": "family string, short_name string, long_name string, num_members int, num_uniref50_members int, num_uniref90_members int",
    "PFAM_clans": "pfam_id string, clan_id string",
    "ena": "ID string, AC string, NUM int, TYPE int, DIRECTION int, start int, stop int",
    "idmapping": "uniprot_id string, foreign_id_type string, foreign_id string",
    "colors": "cluster int, color string",
    "pdbhits": "ACC string, PDB string, e string",
}
LIST_COLUMNS = {"annotations": ["pdb", "GO", "KEGG", "STRING", "BRENDA", "PATRIC", "Cazy"]}
EMPTY_VALUES = ["None", "NA", ""]

# Attribute names in display order with their display names.
ATTRIBUTES: list[tuple[str, str]] = [
    ("ACC", "List of IDs in Rep Node"), ("Cluster Size", "Number of IDs in Rep Node"), ("Sequence_Source", "Sequence Source"),
    ("Query_IDs", "Query IDs"), ("Other_IDs", "Other IDs"), ("Organism", "Organism"), ("Taxonomy_ID", "Taxonomy ID"),
    ("STATUS", "UniProt Annotation Status"), ("Description", "Description"), ("Swissprot_Description", "Swissprot Description"),
    ("Sequence_Length", "Sequence Length"), ("Cluster_ID_Domain_Length", "Cluster ID Domain Length"),
    ("Cluster_ID_Sequence_Length", "Cluster ID Sequence Length"), ("GN", "Gene Name"), ("NCBI_IDs", "NCBI IDs"),
    ("Superkingdom", "Superkingdom"), ("Kingdom", "Kingdom"), ("Phylum", "Phylum"), ("Class", "Class"), ("Order", "Order"),
    ("Family", "Family"), ("Genus", "Genus"), ("Species", "Species"), ("EC", "EC"), ("PFAM", "PFAM"), ("PDB", "PDB"),
    ("IPRO_DOM", "InterPro (Domain)"), ("IPRO_FAM", "InterPro (Family)"), ("IPRO_SUP", "InterPro (Homologous Superfamily)"),
    ("IPRO", "InterPro (Other)"), ("BRENDA", "BRENDA ID"), ("CAZY", "CAZY Name"), ("GO", "GO Term"), ("KEGG", "KEGG ID"),
    ("PATRIC", "PATRIC ID"), ("STRING", "STRING ID"), ("HMP_Body_Site", "HMP Body Site"), ("HMP_Oxygen", "HMP Oxygen"),
    ("P01_gDNA", "P01 gDNA"), ("UniRef50_IDs", "UniRef50 Cluster IDs"), ("UniRef50_Cluster_Size", "UniRef50 Cluster Size"),
    ("UniRef90_IDs", "UniRef90 Cluster IDs"), ("UniRef90_Cluster_Size", "UniRef90 Cluster Size"), ("UniRef100_IDs", "UniRef100 Cluster IDs"),
    ("UniRef100_Cluster_Size", "UniRef100 Cluster Size"), ("ACC_CDHIT", "CD-HIT IDs"), ("ACC_CDHIT_COUNT", "CD-HIT Cluster Size"),
    ("Sequence", "Sequence"), ("User_IDs_in_Cluster", "User IDs in Cluster"), ("Fragment", "Sequence Status"),
]
# Attributes written as lists, as integers, and those whose members are sequences of their own.
LISTS = {
    "IPRO", "PDB", "PFAM", "GO", "HMP_Body_Site", "CAZY", "Query_IDs", "Other_IDs", "Description", "NCBI_IDs", "UniRef50_IDs",
    "UniRef90_IDs", "ACC_CDHIT", "User_IDs_in_Cluster",
}
INTEGERS = {
    "Cluster_ID_Sequence_Length", "Sequence_Length", "Cluster_ID_Domain_Length", "UniRef50_Cluster_Size", "UniRef90_Cluster_Size",
    "UniRef100_Cluster_Size", "ACC_CDHIT_COUNT", "Cluster Size",
}
EXPANDABLE = {"ACC", "ACC_CDHIT", "UniRef50_IDs", "UniRef90_IDs", "UniRef100_IDs"}
UNKNOWN_ORDER = 999


def attribute_catalog(spark: SparkSession) -> DataFrame:
    rows = [(n, d, i, "integer" if n in INTEGERS else "string", n in LISTS, n in EXPANDABLE) for i, (n, d) in enumerate(ATTRIBUTES)]
    return spark.createDataFrame(rows, "name string, display string, position int, dtype string, is_list boolean, expandable boolean")
