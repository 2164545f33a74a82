"""What the submission forms look like: names, codes and rosters.

Everything here is a fixed value that inputs and outputs share.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Columns that identify a submission, and their names in the outputs.
ID_COLUMNS = ["GranteeTypeTxt", "Fy", "ProgAcronym", "PostalCode", "EIN"]
ID_NAMES = {"GranteeTypeTxt": "Grant Type", "Fy": "Year", "ProgAcronym": "Program Acronym", "PostalCode": "State"}
OUT_IDS = ["Grant Type", "Year", "Program Acronym", "State", "EIN"]
LOOKUP_ATTRIBUTES = ["Clients", "In Use", "Demo", "TypeService", "Outcomes"]
RETURNED = "Submission Returned by CO"
ZIP_COLUMNS = {"Grantee Zip4": "string", "Grantee Zip5": "string"}

# Sub-award columns.
NAME = "Subawardee List - Subawardee Name"
CITY = "Subawardee List - City"
AMOUNT = "Subawardee List - FVPSA Funding Amount"
TYPE_RAW = "Subawardee List - Type of Subawardee"
AREA_RAW = "Subawardee List - Classification of urban, rural, suburban or frontier"
SERVED = "Subawardee List - Underserved or culturally- and linguistically-specific population"
FUNDING_TYPE = "Subawardee - FVPSA Funding Type"
SERVICE_TYPE = "Subawardee - FVPSA Primary Services Type"
SUBAWARD_RENAMES = {
    "II Text - FVPSA Funding Type,PPR FVPSA Subawardee - Maze Grid Input Row": FUNDING_TYPE,
    "II Text - Primary Services Type,PPR FVPSA Subawardee - Maze Grid Input Row": SERVICE_TYPE,
}
TYPE, AREA, CULT, STATE, YEAR = "Shelter Type", "Rural Designation", "CultSpec2", "PostalCode", "Fy"
SHELTER_TOTAL, NONSHELTER_TOTAL = "SUBAWARDEE_SHELTER_TOTAL", "SUBAWARDEE_NONSHELTER_TOTAL"

# Client groups of the wide table.
CLIENT_GROUPS = ["Men", "Women", "Children", "Not Specified"]
CLIENT_PREFIXES = ["Shelter", "Non-shelter"]

# Service outcome measures as (name fragment, must name a safety survey).
SAFETY = ["SAFETY", "SAFTY"]
OUTCOME_FAMILIES = {
    "Number of Surveys Completed Resource Outcome": ("NUMBER OF SURVEYS", SAFETY, False),
    "Number of Yes Responses to Resource Outcome": ("NUMBER OF YES RESPONSES", SAFETY, False),
    "Percent Responses Resource Outcome": ("PERCENTAGE", SAFETY, False),
    "Number of Surveys Completed Safety Planning": ("NUMBER OF SURVEYS", SAFETY, True),
    "Number of Yes Responses to Safety Planning": ("NUMBER OF YES RESPONSES", SAFETY, True),
    "Percent Responses Safety Planning": ("PERCENTAGE", SAFETY, True),
}
SURVEY_TYPES = [
    ("Counseling", "Counseling Survey"),
    ("Shelter", "Shelter Survey"),
    ("Support Group", "Support Group Survey"),
    ("Support Services and Advocacy", "Support Services and Advocacy Survey"),
]

# The states expected to report.
STATE_ROSTER = (
    "AK AL AR AZ CA CO CT DC DE FL GA HI IA ID IL IN KS KY LA MA MD ME MI MN MO MS MT NC ND NE NH NJ NM NV NY "
    "OH OK OR PA PR RI SC SD TN TX UT VA VT WA WI WV WY"
).split()
# Coalitions are also expected from these.
COALITION_STATES = sorted([*STATE_ROSTER, "AS", "GU", "MP", "VI"])

# Program codes and names.
CORE, ARP, CARES = "Core FVPSA", "ARP Act", "CARES Act"
TESTING, ASSAULT = "ARP COVID-19 Testing Supplemental", "ARP Support Survivors of Sexual Assualt"
PROGRAMS = {"FVC6": ARP, "FVPS": CORE, "FVC3": CARES}
PROGRAMS_2024 = {**PROGRAMS, "FTC6": TESTING, "FSC6": ASSAULT}
COALITION_PROGRAMS = {"SDVC": CORE, "SDC6": ARP, "SDC3": CARES}
# Fixed values: (year, program) pairs coalitions report on.
COALITION_PERIODS = [
    ("2018", CORE), ("2019", CORE), ("2020", CORE), ("2021", CORE), ("2021", CARES), ("2022", CORE), ("2022", ARP),
    ("2023", CORE), ("2023", ARP), ("2024", CORE), ("2024", ARP),
]

# Headers that occur twice in an extract, and what the lookup calls them.
_H02 = "H-02 What does the FVPSA grant allow you to do that you wouldn¿t be able to do without this funding?"
_H02_AGAIN = "H-02 What does the FVPSA grant allow you to do that you wouldn¿t be able to do without this funding?.1"
_H02_49 = "H-02 WHAT DOES THE FVPSA GRANT ALLOW YOU TO DO THAT YOU WOULDN¿T BE ABLE TO DO WITHOUT THIS FUNDING?...49"
_H02_50 = "H-02 WHAT DOES THE FVPSA GRANT ALLOW YOU TO DO THAT YOU WOULDN¿T BE ABLE TO DO WITHOUT THIS FUNDING?...50"
_H03 = (
    "H-03 Describe any efforts supported in whole or in part by your FVPSA grant to meet the needs of underserved "
    "populations in your community, including populations underserved because of ethnic, racial, cultural or language "
    "diversity, sexual orientation or gender identity or geographic isolation. Describe any ongoing challenges."
)


#: The place of a row in its extract: file, then row. What a table lacks of it is left out.
ROW_ORDER = ("source_path", "row_ix")


@dataclass(frozen=True)
class StateForm:
    """A form year of states and tribes."""

    keys: tuple[str, ...] = ()  # shared columns of the screens; derived from position when empty
    n_key_columns: int = 43
    repairs: Mapping[str, list[str]] = field(default_factory=dict)
    question_names: Mapping[str, str] = field(default_factory=dict)
    name_floor: int = 2018
    row_order: tuple[str, ...] = ROW_ORDER


STATES_V6 = StateForm(repairs={_H02: [_H03]})
STATES_V8 = StateForm(question_names={_H02: _H02_49, _H02_AGAIN: _H02_50})

# Coalition form sections.
SECTIONS = {
    "Screen-1": "I. Cover Page",
    "Screen-2": "II. FVPSA Funds",
    "Screen-3": "III. Coalition Members",
    "Screen-4": "IV. Narrative Questions",
    "Screen-5": "V. Summary of Activities",
    "Screen-6": "VI. Other Topics",
    "Screen-7": "VII. Training",
}
ITERATIONS = ["Screen-Name", "Row-Iteration", "Screen-Iteration"]
ACTIVITY_FAMILIES = {
    "Level of Involvement": "Level of Involvement - ",
    "Types of Activities": "Types of Activities - ",
    "Short Response": "Short Response (Involved and Highly Involved only) - ",
    "Number of People Trained": "Number of People Trained - ",
}
# Headers of the summary of activities, as they come and as they are meant.
ACTIVITY_REPAIRS = {
    "Types of Activities,FVPSA Summary of Activities,R19C2":
        "Types of Activities,FVPSA Summary of Activities,R9C2",
    "Types of Activities,FVPSA Summary of Activities,R19C2.1":
        "Types of Activities,FVPSA Summary of Activities,R19C2",
    "Number of People Reached &lt;BR&gt;(Training /TA only),FVPSA Underserved and culturally-specific populations Summary of Activities,RvC3":
        "Number of People Reached &lt;BR&gt;(Training /TA only),FVPSA Underserved and culturally-specific populations Summary of Activities,R33C3",
    "Number of People Reached &lt;BR&gt;(Training /TA only),FVPSA Underserved and culturally-specific populations Summary of Activities,RvC3.1":
        "Number of People Reached &lt;BR&gt;(Training /TA only),FVPSA Underserved and culturally-specific populations Summary of Activities,R31C3",
}


@dataclass(frozen=True)
class CoalitionForm:
    """A form year of coalitions."""

    code_column: str
    code_name: str
    questions: int
    first_year: str = ""
    last_year: str = "9999"
    row_order: tuple[str, ...] = ROW_ORDER
    pairs: tuple[tuple[str, str], ...] = tuple(COALITION_PERIODS)

    @property
    def renames(self) -> dict[str, str]:
        return {
            "PostalCode": "State", "Fy": "Year", "ProgAcronym": "Program Abbr", "RptEin": "EIN",
            "ProgramName": "Program Name", self.code_column: self.code_name,
        }

    @property
    def periods(self) -> list[tuple[str, str]]:
        return [(y, p) for y, p in self.pairs if self.first_year <= y <= self.last_year]


COALITIONS_V1 = CoalitionForm("DunsId9", "DUNS", questions=5, last_year="2023")
COALITIONS_V2 = CoalitionForm("UEI[Unique Entity Identifier]", "UEI", questions=7, first_year="2024")

# Presentation levels.
REGIONS = [f"Region {i}" for i in range(1, 11)]
TYPE_LEVELS = {
    "Shelter": "Shelter", "Non-shelter": "Non-shelter", "Coalition": "Coalition", "Other": "Other", "Select": "Unspecified",
}
AREA_LEVELS = {
    "Urban": "Urban", "Suburban": "Suburban", "Rural": "Rural", "Frontier": "Frontier", "Select": "Unspecified",
}
