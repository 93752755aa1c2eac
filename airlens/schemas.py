"""Record layouts and fixed names.

The input files are headerless-or-headed comma separated text whose fields are
addressed by position, so a layout is a list of ``(position, name, type)``
triples.  Positions are 0-based from the start, or negative from the end (the
pollution timestamp is "the last field").
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values (must equal the reference's for identical results) -------
# Human-readable attribute labels used in the region report and result table.
POLLUTANT_LABELS = ["Ozone", "Particulate matter", "Carbon monoxide", "Sulfur dioxide", "Nitrogen dioxide"]
# Weather measurement names (one JSON-lines file per measurement).
WEATHER_MEASUREMENTS = ["dewptm", "hum", "pressurem", "tempm", "wdird", "wspdm"]
# Header of the merged training file, in column order.
MERGED_HEADER = [
    "Timestamp", "Latitude", "Longitude", "Average_speed", "Vehicle_count",
    "Is_Monday", "Is_Tuesday", "Is_Wednesday", "Is_Thursday", "Is_Friday", "Is_Saturday", "Is_Sunday",
    "Dew_point", "Humidity", "Pressure", "Temperature", "Wind_direction", "Wind_speed",
    "Ozone", "Particulate_matter", "Carbon_monoxide", "Sulfur_dioxide", "Nitrogen_dioxide",
]
# Timestamp formats: pollution records, traffic records / weather keys.
POLLUTION_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# Merged files separate fields with a comma and a blank.
MERGED_SEP = ", "
# Marker that identifies header lines (case-insensitive substring).
HEADER_MARKER = "timestamp"
# Texts of the printed region report, after or around the attribute's label.
REPORT_COUNT = "Total number of elements: "
REPORT_EMPTY = "There are no elements so no further analysis can be made."
REPORT_RANGE = " range: ["
REPORT_MEAN = " mean: "
REPORT_STD = " standard deviation: "
# --- end of fixed values -----------------------------------------------------

POLLUTANTS = ["ozone", "particulate_matter", "carbon_monoxide", "sulfur_dioxide", "nitrogen_dioxide"]
WEATHER_COLUMNS = dict(zip(WEATHER_MEASUREMENTS, MERGED_HEADER[12:18]))
WEEKDAY_COLUMNS = MERGED_HEADER[5:12]
FEATURES = MERGED_HEADER[3:18]   # 15 model inputs
LABELS = MERGED_HEADER[18:23]    # 5 possible targets


@dataclass(frozen=True)
class Layout:
    """Positional layout of a delimited text record."""

    fields: tuple[tuple[int, str, str], ...]
    ts: tuple[int, str, str] | None        # (position, column name, datetime pattern)
    header_field: int                      # position tested for the header marker
    sep: str = ","

    @property
    def columns(self) -> list[str]:
        return [n for _, n, _ in self.fields] + ([self.ts[1]] if self.ts else [])


POLLUTION = Layout(
    fields=tuple((i, n, "double") for i, n in enumerate(POLLUTANTS))
    + ((5, "longitude", "double"), (6, "latitude", "double")),
    ts=(-1, "ts", POLLUTION_TS_FORMAT),
    header_field=-1,
)

TRAFFIC = Layout(
    fields=((2, "average_speed", "double"), (6, "vehicle_count", "int")),
    ts=(5, "ts", ISO_TS_FORMAT),
    header_field=5,
)

MERGED = Layout(
    fields=((1, "Latitude", "double"), (2, "Longitude", "double"),
            (3, "Average_speed", "double"), (4, "Vehicle_count", "double"))
    + tuple((5 + i, n, "int") for i, n in enumerate(WEEKDAY_COLUMNS))
    + tuple((12 + i, n, "double") for i, n in enumerate(MERGED_HEADER[12:23])),
    ts=(0, "Timestamp", POLLUTION_TS_FORMAT),
    header_field=0,
    sep=",",   # written with ", "; read by splitting on the comma and trimming, so both forms parse
)
