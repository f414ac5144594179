"""Fixed reference data: metros, their codes in each source, what-if scenarios.

Everything here is a small constant list (25 metros, 26 price series, 7
scenarios), so the DataFrames built from it are bounded by this file.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from hearth import schemas

# --- Fixed values -----------------------------------------------------------
# geo_id, metro_name, city_display, state_abbr, region, latitude, longitude,
# state FIPS, CBSA code, fair-market-rent entity id
METROS = [
    (1, "New York-Newark-Jersey City, NY-NJ-PA", "New York", "NY", "Northeast", "40.7128", "-74.0060", "36", "35620", "METRO35620MM5600"),
    (2, "Los Angeles-Long Beach-Anaheim, CA", "Los Angeles", "CA", "West", "34.0522", "-118.2437", "06", "31080", "METRO31080MM4480"),
    (3, "Chicago-Naperville-Elgin, IL-IN-WI", "Chicago", "IL", "Midwest", "41.8781", "-87.6298", "17", "16980", "METRO16980M16980"),
    (4, "Dallas-Fort Worth-Arlington, TX", "Dallas", "TX", "South", "32.7767", "-96.7970", "48", "19100", "METRO19100M19100"),
    (5, "Houston-The Woodlands-Sugar Land, TX", "Houston", "TX", "South", "29.7604", "-95.3698", "48", "26420", "METRO26420M26420"),
    (6, "Washington-Arlington-Alexandria, DC-VA-MD", "Washington DC", "DC", "South", "38.9072", "-77.0369", "11", "47900", "METRO47900M47900"),
    (7, "Miami-Fort Lauderdale-Pompano Beach, FL", "Miami", "FL", "South", "25.7617", "-80.1918", "12", "33100", "METRO33100MM5000"),
    (8, "Philadelphia-Camden-Wilmington, PA-NJ-DE", "Philadelphia", "PA", "Northeast", "39.9526", "-75.1652", "42", "37980", "METRO37980M37980"),
    (9, "Atlanta-Sandy Springs-Alpharetta, GA", "Atlanta", "GA", "South", "33.7490", "-84.3880", "13", "12060", "METRO12060M12060"),
    (10, "Phoenix-Mesa-Chandler, AZ", "Phoenix", "AZ", "West", "33.4484", "-112.0740", "04", "38060", "METRO38060M38060"),
    (11, "Boston-Cambridge-Newton, MA-NH", "Boston", "MA", "Northeast", "42.3601", "-71.0589", "25", "14460", "METRO14460MM1120"),
    (12, "Riverside-San Bernardino-Ontario, CA", "Riverside", "CA", "West", "33.9806", "-117.3755", "06", "40140", "METRO40140M40140"),
    (13, "Seattle-Tacoma-Bellevue, WA", "Seattle", "WA", "West", "47.6062", "-122.3321", "53", "42660", "METRO42660MM7600"),
    (14, "Minneapolis-St. Paul-Bloomington, MN-WI", "Minneapolis", "MN", "Midwest", "44.9778", "-93.2650", "27", "33460", "METRO33460M33460"),
    (15, "San Diego-Chula Vista-Carlsbad, CA", "San Diego", "CA", "West", "32.7157", "-117.1611", "06", "41740", "METRO41740M41740"),
    (16, "Tampa-St. Petersburg-Clearwater, FL", "Tampa", "FL", "South", "27.9506", "-82.4572", "12", "45300", "METRO45300M45300"),
    (17, "Denver-Aurora-Lakewood, CO", "Denver", "CO", "West", "39.7392", "-104.9903", "08", "19740", "METRO19740M19740"),
    (18, "St. Louis, MO-IL", "St. Louis", "MO", "Midwest", "38.6270", "-90.1994", "29", "41180", "METRO41180M41180"),
    (19, "Baltimore-Columbia-Towson, MD", "Baltimore", "MD", "South", "39.2904", "-76.6122", "24", "12580", "METRO12580M12580"),
    (20, "Portland-Vancouver-Hillsboro, OR-WA", "Portland", "OR", "West", "45.5051", "-122.6750", "41", "38900", "METRO38900M38900"),
    (21, "Austin-Round Rock-Georgetown, TX", "Austin", "TX", "South", "30.2672", "-97.7431", "48", "12420", "METRO12420M12420"),
    (22, "Las Vegas-Henderson-Paradise, NV", "Las Vegas", "NV", "West", "36.1699", "-115.1398", "32", "29820", "METRO29820M29820"),
    (23, "San Francisco-Oakland-Berkeley, CA", "San Francisco", "CA", "West", "37.7749", "-122.4194", "06", "41860", "METRO41860MM7360"),
    (24, "Charlotte-Concord-Gastonia, NC-SC", "Charlotte", "NC", "South", "35.2271", "-80.8431", "37", "16740", "METRO16740M16740"),
    (25, "Nashville-Davidson-Murfreesboro-Franklin, TN", "Nashville", "TN", "South", "36.1627", "-86.7816", "47", "34980", "METRO34980M34980"),
]

# Consumer-price series -> city; several cities share one regional series.
CPI_SERIES = [
    ("CUURS12ASA0", "New York"), ("CUURS49ASA0", "Los Angeles"), ("CUURS23ASA0", "Chicago"),
    ("CUURS37ASA0", "Dallas"), ("CUURS37BSA0", "Houston"), ("CUURS35BSA0", "Washington DC"),
    ("CUURS33ASA0", "Miami"), ("CUURS12BSA0", "Philadelphia"), ("CUURS33BSA0", "Atlanta"),
    ("CUURS48ASA0", "Phoenix"), ("CUURS11ASA0", "Boston"), ("CUURS49BSA0", "Riverside"),
    ("CUURS49DSA0", "Seattle"), ("CUURS24ASA0", "Minneapolis"), ("CUURS49CSA0", "San Diego"),
    ("CUURS35ASA0", "Tampa"), ("CUURS48BSA0", "Denver"), ("CUURS23BSA0", "St. Louis"),
    ("CUURS35BSA0", "Baltimore"), ("CUURS49DSA0", "Portland"), ("CUURS37BSA0", "Austin"),
    ("CUURS48ASA0", "Las Vegas"), ("CUURS49BSA0", "San Francisco"), ("CUURS35CSA0", "Charlotte"),
    ("CUURS35ASA0", "Nashville"), ("CUUR0000SA0", "United States"),
]
NATIONAL_CITY = "United States"

# Labor measure code -> column
LABOR_MEASURES = [("03", "unemployment_rate"), ("05", "employment_level"), ("06", "labor_force")]

# scenario_name, mortgage_rate, down_payment_pct, income_assumption, loan_term_years
SCENARIOS = [
    ("Conservative - 10% Down, 7.5% Rate", "7.5000", "10.00", None, 30),
    ("Moderate - 20% Down, 7.0% Rate", "7.0000", "20.00", None, 30),
    ("Optimistic - 20% Down, 6.0% Rate", "6.0000", "20.00", None, 30),
    ("Low Income - $50k Household", "7.0000", "10.00", "50000.00", 30),
    ("Mid Income - $75k Household", "7.0000", "10.00", "75000.00", 30),
    ("Mid Income - $100k Household", "7.0000", "20.00", "100000.00", 30),
    ("High Income - $150k Household", "6.5000", "20.00", "150000.00", 30),
]

ALL_HOMES = "All Homes"
DATE_SPINE = (date(2015, 1, 1), date(2026, 12, 31))
SINCE = date(2015, 1, 1)
YEAR_WINDOWS = [(2015, 2019), (2020, 2026)]
# --- end of fixed values ----------------------------------------------------


def listing_name(city: str, state: str) -> str:
    """Label a metro carries in the rent and home-value files ("City, ST")."""
    return f"{city.removesuffix(' ' + state)}, {state}"


def income_match_key(city: str, state: str) -> str:
    """Text that identifies a metro inside an income-survey metro title."""
    return city.removesuffix(" " + state)


def geography(spark: SparkSession) -> DataFrame:
    rows = [
        (geo, name, city, state, region, cbsa, listing_name(city, state), fips + cbsa,
         Decimal(lat), Decimal(lon), True)
        for geo, name, city, state, region, lat, lon, fips, cbsa, _ in METROS
    ]
    return spark.createDataFrame(rows, schemas.DIM_GEOGRAPHY)


def scenarios(spark: SparkSession) -> DataFrame:
    rows = [
        (i, name, Decimal(rate), Decimal(down), Decimal(inc) if inc else None, term)
        for i, (name, rate, down, inc, term) in enumerate(SCENARIOS, start=1)
    ]
    return spark.createDataFrame(rows, schemas.DIM_SCENARIO)


def listing_crosswalk(spark: SparkSession) -> DataFrame:
    rows = [(listing_name(m[2], m[3]), m[2]) for m in METROS]
    return spark.createDataFrame(rows, "source_key string, city_display string")


def cbsa_crosswalk(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m[8], m[2]) for m in METROS], "source_key string, city_display string")


def fmr_crosswalk(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m[9], m[2]) for m in METROS], "entity_id string, city string")


def cpi_bridge(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CPI_SERIES, "series_id string, city_display string")


def labor_areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(m[2], m[7], m[8]) for m in METROS],
                                 "city_display string, state_fips string, cbsa string")


def income_match_keys() -> list[str]:
    return [income_match_key(m[2], m[3]) for m in METROS]


def labor_measures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LABOR_MEASURES, "measure_code string, measure string")

