"""Input tables: column types, and the headings their files may use."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE, TEXT, DATE = (
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.StringType(),
    T.DateType(),
)


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SALES = _schema(
    sku=LONG, upc=LONG, dept=INT, subdept=INT, class_id=INT, subclass_id=INT,
    period=INT, store=INT, units=DOUBLE, amount=DOUBLE, cost=DOUBLE, closing_stock=DOUBLE,
)
COMPETITOR_PRICES = _schema(upc=LONG, comp_store=INT, comp_price=DOUBLE)
INVENTORY = _schema(
    sku=LONG, store=INT, stock_date=DATE, stock_units=DOUBLE, stock_value=DOUBLE, stock_cost=DOUBLE
)
STORES = _schema(store=INT, store_name=TEXT, format=TEXT, region=TEXT, zone=TEXT, store_type=TEXT)
SKUS = _schema(
    sku=LONG, upc=LONG, description=TEXT, article_group=TEXT, status=TEXT,
    dept=INT, dept_name=TEXT, subdept=INT, subdept_name=TEXT,
    class_id=INT, class_name=TEXT, subclass_id=INT, subclass_name=TEXT, dept_number=TEXT,
)
STORE_DECILES = _schema(sku=LONG, store=INT, decile=TEXT, valid_from=DATE, valid_to=DATE)
NATIONAL_DECILES = _schema(sku=LONG, upc=LONG, decile=TEXT)
TAXES = _schema(sku=LONG, iva=DOUBLE, ieps=DOUBLE)
MATRIX = _schema(
    store=INT, priority=INT, dept=INT, subdept=INT, comp_store=INT, comp_source=TEXT, comp_chain=TEXT
)
PROMO_LIMITS = _schema(dept=INT, subdept=INT, promo_percent=INT)
MARGINS = _schema(dept=INT, subdept=INT, class_id=INT, target_margin=DOUBLE)
PRICE_GROUPS = _schema(sku=LONG, price_group=LONG)
EXCEPTIONS = _schema(sku=LONG, exception=TEXT)

# Headings found in the source files, per column. A column may be headed
# in several ways, depending on the feed.
HEADINGS = {
    "sku": ("SKU", "Articulo"),
    "upc": ("UPC", "EAN_UPC", "barcode"),
    "store": ("Tienda", "Centro"),
    "period": ("Semana",),
    "dept": ("Depto",),
    "subdept": ("SubDepto",),
    "class_id": ("Clase",),
    "subclass_id": ("SubClase",),
    "units": ("VentaUni",),
    "amount": ("VentaPesos",),
    "cost": ("VentaCosto",),
    "closing_stock": ("Invfinvta",),
    "comp_store": ("TiendaCompetencia", "shop", "Tienda"),
    "comp_price": ("PrecioCompetencia", "pr", "Precio"),
    "comp_source": ("FuenteCompetencia",),
    "comp_chain": ("CadenaCompetencia",),
    "priority": ("Prioridad",),
    "stock_date": ("FechaInven",),
    "stock_units": ("InvFinUni",),
    "stock_value": ("InvFinVta",),
    "stock_cost": ("InvFinCto",),
    "store_name": ("Nombre_tda",),
    "format": ("Formato",),
    "region": ("Region",),
    "zone": ("Zona",),
    "store_type": ("Tipo_Tda",),
    "description": ("Descripcion",),
    "article_group": ("GrupoArticulos",),
    "status": ("Estatus",),
    "dept_name": ("DescripDepto",),
    "subdept_name": ("DescripSubdepto",),
    "class_name": ("DescripClase",),
    "subclass_name": ("DescripSubCl",),
    "dept_number": ("Num_Dpt",),
    "decile": ("Decil",),
    "valid_from": ("InicioVigencia",),
    "valid_to": ("FinVigencia",),
    "iva": ("IVA",),
    "ieps": ("IEPS",),
    "promo_percent": ("CambioPromocion",),
    "target_margin": ("MargenObjetivo",),
    "price_group": ("GrupoArticulo",),
    "exception": ("Excepcion",),
}

# Names of the price sources written into the results.
SPOT = "PrecioPuntual"
GROUP = "PrecioGrupo"
GROUP_MODE = "ModaGrupo"
NATIONAL_MODE = "ModaNacional"
NATIONAL_MEDIAN = "MedianaNacional"
MODE_SOURCE = "Moda"

# Chains whose .01-.03 endings mark clearances.
CLEARANCE_CHAINS = ("WALMART CORPORATION", "BODEGA AURRERA")
