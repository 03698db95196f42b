"""Fixed values, dataset definitions and schemas shared by all modules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MISSING = "-"

# ---------------------------------------------------------------------------
# Cell texts the list reader treats as null (the pandas defaults).
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Profile headings of an about page, with the column each one feeds.
HEADING_COLUMNS = {
    "Website": "website",
    "Industry": "industry",
    "Company size": "company_size",
    "No. of associated members": "members",
    "Headquarters": "headquarters",
    "Founded": "founded",
    "Specialties": "specialties",
}
SIZE_HEADING = "Company size"
MEMBERS_HEADING = "No. of associated members"

# Column names of the organisation list.
NAME_COLUMN = "Name"
URL_COLUMN = "LinkedIn"

# Keys shared by every JSON record, with the internal column name.
COMMON_KEYS = {
    "input_company_name": "input_company_name",
    "Company Name": "company_name",
    "LinkedIn URL": "profile_url",
    "Targeted URL": "targeted_url",
    "Redirected to URL": "redirected_url",
    "Error": "error",
    "Time Stamp": "time_stamp",
}

# Column order of the output tables.
ABOUT_COLUMNS = (
    "Input Company Name",
    "Company Name",
    "Associated Members",
    "Website",
    "Industry",
    "Company Size",
    "Headquarters",
    "Founded",
    "Specialties",
    "LinkedIn URL",
    "Time Stamp",
    "Redirected to URL",
)
KEYWORD_MEMBERS = "Quantum Associated Members"
ALL_MEMBERS = "Associated Members"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ExtractionSpec:
    """Everything about the page layout that extraction depends on."""

    keyword: str = "quantum"
    about_path: str = "/about/"
    people_path: str = "/people/"
    unavailable_marker: str = "/unavailable/"
    title_class: str = "org-top-card-summary__title"
    header_class: str = "org-people__header-spacing-carousel"
    bar_class: str = "org-people-bar-graph-element"
    category_class: str = "org-people-bar-graph-element__category"
    item_attr: str = "data-item-index"
    locations_index: str = "0"
    roles_index: str = "2"
    headings: dict[str, str] = field(default_factory=lambda: dict(HEADING_COLUMNS))

    @property
    def suffixes(self) -> dict[str, str]:
        """Page kind -> what is added to the base URL."""
        return {
            "about": self.about_path,
            "people_kw": f"{self.people_path}?keywords={self.keyword}",
            "people": self.people_path,
        }

    @property
    def text_tags(self) -> frozenset[str]:
        return frozenset({"h1", "h2", "dt", "dd", "strong", "span"})

    @property
    def marker_classes(self) -> frozenset[str]:
        return frozenset({self.header_class, self.bar_class})

    @property
    def marker_attrs(self) -> frozenset[str]:
        return frozenset({self.item_attr})


@dataclass(frozen=True)
class Dataset:
    """One of the five record datasets and the tables made from it."""

    name: str
    page_kind: str
    file_name: str
    table_name: str
    facet: str | None = None
    list_key: str | None = None
    label_key: str | None = None
    members_key: str | None = None
    default_label: str = MISSING

    def record_schema(self) -> T.StructType:
        """Schema of the JSON records; the list field may hold a list or a text."""
        if self.facet is None:
            keys = [*COMMON_KEYS, *HEADING_COLUMNS]
            return T.StructType([T.StructField(k, T.StringType()) for k in keys])
        fields = [T.StructField(k, T.StringType()) for k in [*COMMON_KEYS, self.members_key]]
        return T.StructType([*fields, T.StructField(self.list_key, T.VariantType())])


def _people(name: str, facet: str, keyword: bool, file_name: str) -> Dataset:
    return Dataset(
        name=name,
        page_kind="people_kw" if keyword else "people",
        file_name=file_name,
        table_name=("where_they_live" if facet == "locations" else "what_they_do")
        + ("_with_quantum" if keyword else "_without_quantum"),
        facet=facet,
        list_key="Locations" if facet == "locations" else "Roles",
        label_key="Location" if facet == "locations" else "Role",
        members_key=KEYWORD_MEMBERS if keyword else ALL_MEMBERS,
        default_label=MISSING if facet == "locations" else "Unknown Role",
    )


# Names of the record files.
DATASETS: dict[str, Dataset] = {
    d.name: d
    for d in (
        Dataset("about", "about", "about_data.json", "about_data"),
        _people("locations_kw", "locations", True, "where_they_live_with_quantum_data.json"),
        _people("locations_all", "locations", False, "where_they_live_without_quantum_data.json"),
        _people("roles_kw", "roles", True, "what_they_do_data_with_quantum.json"),
        _people("roles_all", "roles", False, "what_they_do_data_without_quantum.json"),
    )
}

ORG_SCHEMA = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("profile_url", T.StringType())]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("requested_url", T.StringType()),
        T.StructField("final_url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("captured_at", T.TimestampNTZType()),
    ]
)
