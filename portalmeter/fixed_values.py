"""Fixed values of the portal's vocabulary.

Everything in this module is a value that has to be exactly so for results to come out right: section phrases,
labels, column and file names, and the monthly totals from before the first load. There is no logic here.
"""

from __future__ import annotations

# --- fixed values: analytics vocabulary ---------------------------------------------------------------------

LOAD_EVENT = "load_complete"
RESOURCE_CATEGORY = "Resource"
DOWNLOAD_ACTION = "Download"
NOT_SET_PATTERN = r"|not set|\(not set\)"

LANGUAGES = ("es", "en", "eu", "ca", "gl")
CATALOGUE_SEGMENT = "catalogo"
NAME_PATTERN = "[a-z0-9_-]+"

CATALOGUE_PHRASES = (
    "conjuntos de datos|datasets|conjunts de dades|conxuntos de datos|datu-multzoak|servicios de datos|dataservices"
    "|serveis de dades|servizos de datos|datu-zerbitzuak"
)

# Current feed: (name, section column, phrases). The site total comes first and has no phrases.
CURRENT_SECTIONS = (
    ("catalogo", "section_s2", CATALOGUE_PHRASES),
    ("iniciativas", "section_s2", "iniciativas|initiatives|iniciatives|ekimenen|mapa de iniciativas|initiative map|mapa d'iniciatives|ekimenen mapa"),
    ("documentacion", "section_s2", "documentacion|documentation|documentacio|dokumentazioa"),
    ("aplicaciones", "section_s2", "aplicaciones|applications|aplicacions|aplikazioak"),
    ("empresas-reutilizadoras", "section_s2", "empresas|companies|empreses|enpresak|empresas reutilizadoras|reuse companies|empreses reutilitzadores|enpresa berrerabiltzaileak"),
    ("peticiones-datos", "section_s2", "solicitud de datos|data request|sol·licitud de dades|solicitude de datos|datuak eskatzea|disponibilidad de datos|data availability|disponibilitat de dades|disponibilidade de datos|datuen erabilgarritasuna"),
    ("dashboard", "section_s2", "metricas e impacto|metrics and impact|metriques i impacte|metrikak eta eragina|cuadro de mando|dashboard|quadre de comandament|cadro de mando|aginte-koadroa"),
    ("noticias", "section_s2", "noticias|news|noticies|novas|berriak"),
    ("eventos", "section_s2", "eventos|events|esdeveniments|gertaerak"),
    ("entrevistas", "section_s2", "entrevistas|interviews|entrevistes|elkarrizketak"),
    ("boletines", "section_s2", "boletines|newsletters|butlletins|boletins|buletinak"),
    ("blog_blog", "section_s2", "blog|bloc|bloga"),
    ("apoyo-publicadores", "section_s2", "apoyo a publicadores|support for publishers|recolzament a publicadors|apoio a publicadores|argitaratzaileentzako laguntza|asesoramiento y soporte|advice and support|assessorament i suport|asesoramento e soporte|aholkularitza eta laguntza"),
    ("entornos-seguros", "section_s2", "entornos seguros|safe environments|entorns segurs|interfaces seguras|ingurune seguruak|acceso nsip|nsip access|acces nsip|nsip sarbidea"),
    ("espacios-datos", "section_s2", "espacios de datos|data spaces|espais de dades|espazos de datos|datuen eremua"),
    ("desafios", "section_s2", "desafios|challenges|desafiaments|erronkak|desafio aporta|aporta challenge|desafiament aporta|aporta erronka"),
    ("sectores", "section_s2", "sectores|sectors|sektoreak"),
    ("ejercicios-datos", "section_s2", "ejercicios de datos|data exercises|exercicis de dades|exercicios de datos|datuen erabilerak"),
    ("infografias", "section_s2", "infografias|infographics|infografies|infografiak"),
    ("informes-guias", "section_s2", "informes y guias|reports and guides|informes i guies|informes e guias|informeak eta gidak"),
    ("encuentros-aporta", "section_s2", "encuentros aporta|aporta meetings|trobades aporta|encontros achega|aporta bilerak|encontros aporta"),
    ("que-hacemos", "section_s2", "que hacemos|what we do|que fem|que facemos|aporta ekimenari buruz|zer egiten dugu|acerca de la iniciativa aporta|about the aporta initiative|sobre la iniciativa aporta|sobre a iniciativa aporta"),
    ("preguntas-frecuentes", "section_s2", "preguntas frecuentes|frequently asked questions|preguntes frequents|ohiko galderak"),
    ("tecnologia", "section_s2", "tecnologia|technology|tecnoloxia|teknologia"),
    ("contacto", "section_s2", "contacto|contact|contacte|kontaktua"),
    ("mapa-sitio", "section_s2", "mapa del sitio|site map|mapa del lloc|mapa do sitio|lekuaren mapa"),
    ("api", "section_s2", "api"),
    ("punto-sparql", "section_s2", "punto sparql|sparql endpoint|punt sparql|sparql puntua"),
    ("accesibilidad", "section_s1", "accesibilidad|accessibility|accessibilitat|accesibilidade|irisgarritasuna|eskuragarritasuna"),
    ("aviso-legal", "section_s1", "aviso legal|legal notice|avis legal|legezko abisu"),
    ("agricultura", "section_s3", "agricultura|environment|medi ambient|medio ambiente|ingurumena"),
    ("cultura", "section_s3", "cultura y ocio|culture and leisure|cultura i lleure|cultura e lecer|kultura eta aisia"),
    ("educacion", "section_s3", "educacion|education|educacio|hezkuntza"),
    ("transporte", "section_s3", "transporte|transport|garraioa"),
    ("salud-bienestar", "section_s3", "salud|healthcare|salut|saude|osasuna|salud y bienestar|health & wellness|salut i benestar|saude e benestar"),
    ("turismo", "section_s3", "turismo|tourism|turisme|turismoa"),
    ("justicia-sociedad", "section_s3", "legislacion y justicia|legislation and justice|legislacio i justicia|lexislacion e xustiza|legegintza eta justizia|justicia y sociedad|justice and society|justicia i societat|xustiza e sociedade|justizia eta gizartea"),
    ("ciencia-tecnologia", "section_s3", "ciencia y tecnologia|science and technology|ciencia i tecnologia|ciencia e tecnoloxia|zientzia eta teknologia"),
    ("comercio", "section_s3", "comercio|commerce|comerç|merkataritza"),
    ("demografia", "section_s3", "demografia|demography"),
    ("deporte", "section_s3", "deporte|sport|esport|kirola"),
    ("economia", "section_s3", "economia|economy|ekonomia"),
    ("empleo", "section_s3", "empleo|employment|ocupacio|emprego|enplegua"),
    ("energia", "section_s3", "energia|energy|enerxia"),
    ("hacienda", "section_s3", "hacienda|treasury|hisenda|facenda|ogasuna"),
    ("industria", "section_s3", "industria|industry"),
    ("medio-rural", "section_s3", "medio rural|rural environment|medi rural|nekazaritza"),
    ("sector-publico", "section_s3", "sector publico|public sector|sector public|sektore publikoa"),
    ("seguridad", "section_s3", "seguridad|security|seguretat|seguridade|segurtasuna"),
    ("sociedad-bienestar", "section_s3", "sociedad y bienestar|society and welfare|societat i benestar|sociedade e benestar|gizartea eta ongizatea"),
    ("urbanismo-infraestructuras", "section_s3", "urbanismo e infraestructuras|town planning and infrastructures|urbanisme i infraestructures|urbanismo e infraestruturas|hirigintza eta azpiegiturak"),
    ("vivienda", "section_s3", "vivienda|housing|habitatge|vivenda|etxebizitza"),
)

# Legacy feed: (name, phrases); all of them look at the second section.
LEGACY_SECTIONS = (
    ("catalogo", CATALOGUE_PHRASES),
    ("iniciativas", "mapa de iniciativas|initiative map|mapa d'iniciatives|ekimenen mapa"),
    ("documentacion", "documentacion|documentation|documentacio|dokumentazioa"),
    ("aplicaciones", "aplicaciones|applications|aplicacions|aplikazioak"),
    ("empresas-reutilizadoras", "empresas reutilizadoras|reuse companies|empreses reutilitzadores|enpresa berrerabiltzaileak"),
    ("peticiones-datos", "disponibilidad de datos|data availability|disponibilitat de dades|disponibilidade de datos|datuen erabilgarritasuna"),
    ("dashboard", "cuadro de mando|dashboard|quadre de comandament|cadro de mando|aginte-koadroa"),
    ("noticias", "noticias|news|noticies|berriak"),
    ("eventos", "eventos|events|esdeveniments|gertaerak|jardunaldiak"),
    ("entrevistas", "entrevistas|interviews|entrevistes|elkarrizketak"),
    ("boletines", "boletines|newsletters|butlletins|boletins|buletinak"),
    ("blog_blog", "blog|bloc|bloga|blog-a"),
    ("agricultura", "agricultura|environment|medi ambient|medio ambiente|ingurumena"),
    ("cultura", "cultura y ocio|culture and leisure|cultura i lleure|cultura e lecer|kultura eta aisia"),
    ("educacion", "educacion|education|educacio|hezkuntza"),
    ("transporte", "transporte|transport|garraioa"),
    ("salud-bienestar", "salud y bienestar|health & wellness|salut i benestar|saude e benestar"),
    ("turismo", "turismo|tourism|turisme|turismoa"),
    ("justicia-sociedad", "justicia y sociedad|justice and society|justicia i societat|xustiza e sociedade|justizia eta gizartea"),
)

# Site totals of the months before the first load: (month, sessions); each month is complete.
HISTORIC_SESSIONS = (
    ("2011-11", 3436), ("2011-12", 2129),
    ("2012-01", 4304), ("2012-02", 4883), ("2012-03", 4569), ("2012-04", 4215), ("2012-05", 5614), ("2012-06", 9705),
    ("2012-07", 6929), ("2012-08", 4716), ("2012-09", 6469), ("2012-10", 10181), ("2012-11", 9192), ("2012-12", 7989),
    ("2013-01", 8197), ("2013-02", 8383), ("2013-03", 8729), ("2013-04", 12309), ("2013-05", 12172), ("2013-06", 11589),
    ("2013-07", 11424), ("2013-08", 8009), ("2013-09", 11273), ("2013-10", 13978), ("2013-11", 14329), ("2013-12", 12755),
    ("2014-01", 16925), ("2014-02", 15131), ("2014-03", 17044), ("2014-04", 15550), ("2014-05", 17047), ("2014-06", 14011),
    ("2014-07", 15533), ("2014-08", 11531), ("2014-09", 18702), ("2014-10", 30879), ("2014-11", 30642), ("2014-12", 33593),
    ("2015-01", 31333), ("2015-02", 33655), ("2015-03", 38037), ("2015-04", 36535), ("2015-05", 43418), ("2015-06", 41957),
    ("2015-07", 32245), ("2015-08", 17601), ("2015-09", 23452), ("2015-10", 35257), ("2015-11", 37968), ("2015-12", 34513),
    ("2016-01", 37076), ("2016-02", 40630), ("2016-03", 41106), ("2016-04", 43842), ("2016-05", 47457), ("2016-06", 40985),
    ("2016-07", 33355), ("2016-08", 30432), ("2016-09", 37721), ("2016-10", 42648), ("2016-11", 44961), ("2016-12", 23445),
    ("2017-01", 23164), ("2017-02", 27608),
)

# --- fixed values: catalogue labels -------------------------------------------------------------------------

ORG_CODE_KEY = "C_ID_UD_ORGANICA"

LEVEL_LABELS = {
    "A": "Administración Autonómica",
    "E": "Administración del Estado",
    "L": "Administración Local",
    "P": "Entidad Privada",
    "U": "Universidades",
    "G": "Otras instituciones",
    "I": "Otras instituciones",
}
LEVEL_UNCLASSIFIED = "No clasificado"
LEVEL_UNKNOWN = "Desconocido"

# Order of the rows in "datasets by level" (by letter) and in "publishers by level" (by label).
LEVEL_CODE_ORDER = ("A", "E", "G/I", "L", "P", "U")
LEVEL_LABEL_ORDER = (
    "Administración del Estado",
    "Administración Autonómica",
    "Administración Local",
    "Universidades",
    "Otras instituciones",
    "Entidad Privada",
)

THEME_PATH = "/kos/"
THEME_SECTOR_PATH = "/kos/sector-publico/sector/"
THEME_OTHER = "Otro"
THEME_LABELS = {
    "sector-publico": "Sector público",
    "empleo": "Empleo",
    "demografia": "Demografía",
    "sociedad-bienestar": "Sociedad y bienestar",
    "educacion": "Educación",
    "medio-ambiente": "Medio ambiente",
    "economia": "Economía",
    "salud": "Salud",
    "hacienda": "Hacienda",
    "legislacion-justicia": "Legislación y justicia",
    "turismo": "Turismo",
    "medio-rural-pesca": "Medio Rural",
    "vivienda": "Vivienda",
    "transporte": "Transporte",
    "ciencia-tecnologia": "Ciencia y tecnología",
    "urbanismo-infraestructuras": "Urbanismo e infraestructuras",
    "cultura-ocio": "Cultura y ocio",
    "comercio": "Comercio",
    "seguridad": "Seguridad",
    "energia": "Energía",
    "industria": "Industria",
    "deporte": "Deporte",
}

FORMAT_LABELS = {
    "text/csv": "CSV",
    "application/json": "JSON",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "XLSX",
    "text/html": "HTML",
    "text/pc-axis": "PC-Axis",
    "application/vnd.ms-excel": "XLS",
    "application/pdf": "PDF",
    "image/png": "PNG",
    "text/tab-separated-values": "TSV",
    "text/xml": "XML",
    "application/xml": "XML",
    "image/jpeg": "JPG",
    "application/vnd.google-earth.kml+xml": "KML",
    "text/wms": "WMS",
    "image/tiff": "TIFF",
    "application/zip": "ZIP",
    "text/ascii": "ASCII",
    "text/plain": "plain",
    "application/api": "API",
    "application/x-zipped-shp": "SHP",
    "text/turtle": "RDF-Turtle",
    "application/vnd.oasis.opendocument.spreadsheet": "ODS",
    "application/rdf+xml": "RDF-XML",
    "application/vnd.google-earth.kmz": "KMZ",
    "application/vnd.geo+json": "GeoJSON",
    "application/gml+xml": "GML",
    "application/octet-stream": "OCTET-STREAM",
    "application/ld+json": "JSON-LD",
    "application/atom+xml": "Atom",
    "application/geopackage+sqlite3": "GeoPackage",
    "application/rss+xml": "RSS",
    "text/n3": "RDF-N3",
    "application/vnd.ogc.wms_xml": "WMS-XML",
    "application/scorm": "SCORM",
    "application/elp": "ELP",
    "application/x-turtle": "TURTLE",
    "text/rdf+n3": "N3",
    "application/netcdf": "NetCDF",
    "application/xhtml+xml": "XHTML",
    "application/sparql-query": "SPARQL",
    "application/x-zip-compressed": "ZIP",
    "application/geo+pdf": "GeoPDF",
    "application/geo+json": "GeoJSON",
    "text/wfs": "WFS",
    "application/javascript": "JSON-P",
    "application/gpx+xml": "GPX",
    "text/calendar": "Calendar",
    "application/gzip": "GZIP",
    "application/ecw": "ECW",
    "application/msaccess": "MDB",
    "image/vnd.dwg": "DWG",
    "application/vnd.oasis.opendocument.text": "ODT",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "DOCX",
    "application/marc": "MARC",
    "application/x-tmx+xml": "TMX",
    "image/jp2": "JP2",
    "text/wcs": "WCS",
    "application/solr": "Solr",
    "image/vnd.djvu": "DjVu",
    "application/x-qgis": "QGIS",
    "application/msword": "DOC",
    "text/rtf": "RTF",
    "image/vnd.dgn": "DGN",
    "application/xbrl": "XBRL",
    "application/ecmascript": "ECMAScript",
    "application/las": "LAS",
    "application/x-json": "JSON",
    "application/x-rar-compressed": "RAR",
    "application/x-tbx+xml": "TBX",
    "application/vnd.apache.parquet": "Parquet",
    "image/svg+xml": "SVG",
    "application/dbf": "DBF",
    "application/epub+zip": "ePub",
    "application/sparql-results+xml": "SPARQL-XML",
    "text/xml+georss": "GeoRSS",
    "application/sparql-results+json": "SPARQL-JSON",
    "application/csw": "CSW",
    "application/dxf": "DXF",
    "x-lml/x-gdb": "GDB",
    "application/mp4": "MP4",
    "application/soap+xml": "SOAP",
}

# Content types of the content site, in report order.
CONTENT_TYPE_LABELS = {
    "aplicacion": "Aplicación",
    "blog": "Blog",
    "peticion_de_datos": "Consulta de disponiblidad de datos",
    "desafio_aporta": "Desafío Aporta",
    "documentacion": "Documentación",
    "empresa_reutilizadora": "Empresa reutilizadora",
    "entrevista": "Entrevista",
    "evento": "Evento",
    "faq": "FAQ",
    "iniciativa": "Iniciativa",
    "noticia": "Noticia",
    "ponentes_aporta": "Ponentes Aporta",
    "page": "Página",
    "sectores": "Sectores",
}

CONTENT_SECTIONS = (
    "aplicaciones",
    "documentacion",
    "empresas-reutilizadoras",
    "entrevistas",
    "eventos",
    "iniciativas",
    "noticias",
    "peticiones-datos",
    "blog_blog",
)
SECTOR_SECTIONS = (
    "agricultura",
    "cultura",
    "educacion",
    "transporte",
    "salud-bienestar",
    "turismo",
    "justicia-sociedad",
)
COUNTED_CONTENT_TYPES = ("app", "initiative", "request", "success")
COMMENT_TYPES = ("content_comments", "dataset_comments")

MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
ALL_TIME_LABEL = "Total acumulado"

# --- fixed values: report columns and file names --------------------------------------------------------------

COL_MONTH = "Mes"
COL_URL = "Url"
COL_DATASET = "Conjunto de datos"
COL_PUBLISHER = "Publicador"
COL_VISITS = "Visitas"
COL_ORGANISATION = "Organismo"
COL_FILES_PER_DATASET = "Número de distribuciones por conjunto de datos"
COL_DATASET_COUNT = "Número total de conjuntos de datos"
COL_UPDATED = "Fecha de actualización de los datos"
COL_LEVEL = "Nivel de administración"
COL_UPDATE_MODE = "Tipo de actualización"
COL_CONTENT_TYPE = "Tipo de contenido"
COL_CONTENT_COUNT = "Número de contenidos"
COL_USER_COUNT = "Número total de usuarios"

REPORT_FILES = {
    "datasets_evolution": "catalogo_datos_publico_evolucion",
    "datasets_by_admin_level": "catalogo_datos_por_nivel_administracion",
    "datasets_by_theme": "catalogo_datos_por_categoria",
    "datasets_by_format": "catalogo_datos_por_formato_distribucion",
    "contents_by_type": "contenido_publico_por_tipo",
    "visits_evolution": "visitas_publico_evolucion",
    "catalogue_visits_evolution": "visitas_publico_catalogo_nacional",
    "content_section_visits": "visitas_publico_contenido",
    "sector_visits": "visitas_publico_sectores",
    "top_datasets_per_month": "visitas_publico_mas_vistos",
    "datasets_evolution_by_admin_level": "catalogo_admin_evolucion_nivel_administracion",
    "datasets_by_org_monthly": "catalogo_admin_organismos",
    "distributions_histogram": "catalogo_admin_distribuciones",
    "dataset_visits_detail": "visitas_admin_mas_vistos",
    "comments_received": "contenidos_admin_comentarios_recibidos",
    "publishers_evolution": "publicadores_admin_evolucion",
    "publishers_by_level_and_mode": "publicadores_admin_nivel_administracion",
    "publisher_update_mode": "publicadores_admin_nivel_administracion_forma_actualizacion",
    "contents_by_type_admin": "contenido_por_tipo_administracion",
    "data_requests_by_state": "disponibilidad_datos_por_estado",
    "users_by_org": "usuarios_por_organismo",
    "users_by_admin_level": "usuarios_por_nivel_administracion",
}
