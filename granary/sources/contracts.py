"""Contracts of the retail feed: columns, logical types, limits, keys and watermarks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LOGICAL = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "decimal": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


@dataclass(frozen=True)
class TableSpec:
    """A table's schema (limits are field metadata), primary key and watermark column."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    watermark: str | None = None

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv"

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def text_schema(self) -> T.StructType:
        """Every column as text, to be cast under this library's own rules."""
        return T.StructType([T.StructField(n, T.StringType()) for n in self.columns])


def column(name: str, logical: str, *, required: bool = True, **limits) -> T.StructField:
    """A column; limits are minimum, maximum, allowed (values) and pattern (of the whole value)."""
    limits = {k: float(v) if k in ("minimum", "maximum") else v for k, v in limits.items()}
    return T.StructField(name, LOGICAL[logical], not required, {"logical": logical, "required": required, **limits})


# fixed values: the feed's tables, their columns, limits, keys and watermark columns
TABLES = (
    TableSpec(
        "Fact_Sales", key=("Date", "Store_ID", "Product_ID"), watermark="Date", schema=T.StructType([
            column("Date", "date"),
            column("Store_ID", "string", pattern=r"S\d{3}"),
            column("Product_ID", "string", pattern=r"P\d{5}"),
            column("Inventory_Level", "integer", minimum=0),
            column("Units_Sold", "integer", minimum=0),
            column("Units_Ordered", "integer", minimum=0),
            column("Price", "decimal", minimum=0),
            column("Discount", "decimal", minimum=0, maximum=1),
            column("Promotion", "string", required=False),
            column("Holiday", "string", required=False),
            column("Weather", "string", allowed=["Cloudy", "Cold Wave", "Fog", "Heat Wave", "Rainy", "Storm", "Sunny"]),
            column("Competitor_Price", "decimal", minimum=0),
            column("Temperature", "decimal"),
            column("Humidity", "decimal", minimum=0, maximum=100),
            column("Rainfall", "decimal", minimum=0),
            column("Revenue", "decimal", minimum=0),
        ]),
    ),
    TableSpec(
        "Fact_Inventory", key=("Date", "Store_ID", "Product_ID"), watermark="Date", schema=T.StructType([
            column("Date", "date"),
            column("Store_ID", "string", pattern=r"S\d{3}"),
            column("Product_ID", "string", pattern=r"P\d{5}"),
            column("Opening_Stock", "integer", minimum=0),
            column("Received_Stock", "integer", minimum=0),
            column("Sold", "integer", minimum=0),
            column("Damaged", "integer", minimum=0),
            column("Closing_Stock", "integer", minimum=0),
        ]),
    ),
    TableSpec(
        "Fact_PurchaseOrders", key=("PO_ID",), watermark="Order_Date", schema=T.StructType([
            column("PO_ID", "string", pattern=r"PO\d{7}"),
            column("Supplier_ID", "string", pattern=r"SUP\d{3}"),
            column("Store_ID", "string", pattern=r"S\d{3}"),
            column("Product_ID", "string", pattern=r"P\d{5}"),
            column("Order_Date", "date"),
            column("Expected_Delivery_Date", "date"),
            column("Quantity", "integer", minimum=1),
            column("Status", "string", allowed=["Delivered", "Pending"]),
        ]),
    ),
    TableSpec(
        "Dim_Product", key=("Product_ID",), schema=T.StructType([
            column("Product_ID", "string", pattern=r"P\d{5}"),
            column("Product_Name", "string"),
            column("Base_Product_Name", "string"),
            column("Category", "string", allowed=["Clothing", "Electronics", "Furniture", "Groceries", "Toys"]),
            column("Sub_Category", "string"),
            column("Brand", "string"),
            column("Unit_Cost", "decimal", minimum=0),
            column("Selling_Price", "decimal", minimum=0),
            column("Safety_Stock", "integer", minimum=0),
            column("Reorder_Point", "integer", minimum=0),
            column("Shelf_Life", "integer", minimum=0),
            column("Supplier_ID", "string", pattern=r"SUP\d{3}"),
            column("Weight", "decimal", minimum=0),
            column("Volume", "decimal", minimum=0),
        ]),
    ),
    TableSpec(
        "Dim_Store", key=("Store_ID",), schema=T.StructType([
            column("Store_ID", "string", pattern=r"S\d{3}"),
            column("Store_Name", "string"),
            column("City", "string"),
            column("State", "string"),
            column("Region", "string", allowed=["Central", "East", "North", "South", "West"]),
            column("Store_Size", "string", allowed=["Large", "Medium", "Small"]),
            column("Warehouse_ID", "string", pattern=r"WH\d{2}"),
        ]),
    ),
    TableSpec(
        "Dim_Date", key=("Date",), watermark="Date", schema=T.StructType([
            column("Date", "date"),
            column("Year", "integer"),
            column("Month", "integer", minimum=1, maximum=12),
            column("Day", "integer", minimum=1, maximum=31),
            column("Weekday", "string", allowed=["Friday", "Monday", "Saturday", "Sunday", "Thursday", "Tuesday", "Wednesday"]),
            column("Quarter", "integer", minimum=1, maximum=4),
            column("IsWeekend", "boolean"),
            column("Season", "string", allowed=["Monsoon", "Post-Monsoon", "Summer", "Winter"]),
        ]),
    ),
    TableSpec(
        "Dim_Supplier", key=("Supplier_ID",), schema=T.StructType([
            column("Supplier_ID", "string", pattern=r"SUP\d{3}"),
            column("Supplier_Name", "string"),
            column("Lead_Time_Days", "integer", minimum=1),
            column("MOQ", "integer", minimum=1),
            column("Reliability", "decimal", minimum=0, maximum=1),
            column("Supplier_City", "string"),
            column("State", "string"),
            column("Country", "string"),
            column("Email", "string", pattern=r"[^@\s]+@[^@\s]+\.[^@\s]+"),
            column("Phone", "string", pattern=r"\+91-\d{10}"),
        ]),
    ),
    TableSpec(
        "Dim_Warehouse", key=("Warehouse_ID",), schema=T.StructType([
            column("Warehouse_ID", "string", pattern=r"WH\d{2}"),
            column("Warehouse_Name", "string"),
            column("City", "string"),
            column("State", "string"),
            column("Region", "string", allowed=["Central", "East", "North", "South", "West"]),
            column("Capacity_Units", "integer", minimum=1),
        ]),
    ),
    TableSpec(
        "Weather", key=("Date", "City"), watermark="Date", schema=T.StructType([
            column("Date", "date"),
            column("City", "string"),
            column("Temperature", "decimal"),
            column("Humidity", "decimal", minimum=0, maximum=100),
            column("Rainfall", "decimal", minimum=0),
            column("Weather", "string", allowed=["Cloudy", "Cold Wave", "Fog", "Heat Wave", "Rainy", "Storm", "Sunny"]),
        ]),
    ),
    TableSpec(
        "Promotion", key=("Promotion_ID",), watermark="End_Date", schema=T.StructType([
            column("Promotion_ID", "string", pattern=r"PROMO\d{4}"),
            column("Promotion_Name", "string"),
            column("Start_Date", "date"),
            column("End_Date", "date"),
            column("Discount_Pct", "decimal", minimum=0, maximum=1),
        ]),
    ),
    TableSpec(
        "Holiday", key=("Date",), watermark="Date", schema=T.StructType([
            column("Date", "date"),
            column("Holiday_Name", "string"),
        ]),
    ),
)

CONTRACTS = {spec.name: spec for spec in TABLES}


def contract(name: str) -> TableSpec:
    """The table's contract; ``KeyError`` for an unknown name."""
    if name not in CONTRACTS:
        raise KeyError(f"no contract for table {name!r}; known: {', '.join(CONTRACTS)}")
    return CONTRACTS[name]
