"""Country, region and regional-warehouse vocabulary."""

# Countries of each region.
REGION_COUNTRIES = {
    "AFRICA": [
        "Angola", "Benin", "Botswana", "Burkina Faso", "Burundi", "Cameroon", "Congo, DRC",
        "Côte d'Ivoire", "Ethiopia", "Ghana", "Guinea", "Kenya", "Lesotho", "Liberia", "Libya",
        "Malawi", "Mali", "Mozambique", "Namibia", "Nigeria", "Rwanda", "Senegal",
        "Sierra Leone", "South Africa", "South Sudan", "Sudan", "Swaziland", "Tanzania", "Togo",
        "Uganda", "Zambia", "Zimbabwe",
    ],
    "ASIA": ["Afghanistan", "Pakistan", "Vietnam", "Thailand", "China", "Japan", "Korea",
             "India"],
    "EURASIA": ["Kazakhstan", "Kyrgyzstan"],
    "MIDDLE_EAST": ["Lebanon"],
    "AMERICAS": ["Belize", "Dominican Republic", "Guatemala", "Guyana", "Haiti", "USA",
                 "Canada", "Puerto Rico"],
    "EUROPE": ["UK", "Germany", "France", "Switzerland", "Italy", "Spain", "Cyprus", "Greece",
               "Netherlands", "Norway", "Poland"],
    "OCEANIA": ["Australia"],
}
COUNTRY_REGION = {c: r for r, cs in REGION_COUNTRIES.items() for c in cs}

# Countries served by the southern warehouse of their region.
SOUTHERN_AFRICA = ["South Africa", "Botswana", "Namibia", "Lesotho", "Swaziland", "Zimbabwe",
                   "Zambia", "Malawi", "Mozambique"]
# Warehouse of each region.
REGION_WAREHOUSE = {
    "AFRICA": "WH01", "ASIA": "WH03", "EURASIA": "WH03", "MIDDLE_EAST": "WH03",
    "AMERICAS": "WH04", "EUROPE": "WH05", "OCEANIA": "WH03",
}
SOUTHERN_WAREHOUSE = "WH02"
DEFAULT_WAREHOUSE = "WH03"

# Keywords that reveal the country of a site; the first hit wins.
SITE_KEYWORDS = [
    ("South Africa", "South Africa"), ("Cape Town", "South Africa"), ("Aranda", "South Africa"),
    ("India", "India"), (" IN", "India"), ("INDIA", "India"), ("Nashik", "India"),
    ("Hyderabad", "India"), ("Daman", "India"), ("Goa", "India"), ("Mahar", "India"),
    ("USA", "USA"), (" US", "USA"), ("Chicago", "USA"), ("Elkton", "USA"),
    ("P'burg USA", "USA"),
    ("Germany", "Germany"), (" DE", "Germany"), ("Wiesbaden", "Germany"),
    ("Ludwigshafen", "Germany"), ("Oranienburg", "Germany"),
    ("UK", "UK"), ("Crawley", "UK"), ("Barnard Castle", "UK"), ("Ware", "UK"),
    ("France", "France"), ("Japan", "Japan"), ("Korea", "Korea"), ("Thailand", "Thailand"),
    ("China", "China"), ("Shanghai", "China"),
    ("Switzerland", "Switzerland"), ("Basel", "Switzerland"),
    ("Canada", "Canada"), ("Mississauga", "Canada"),
    ("Madrid", "Spain"), ("Anagni", "Italy"), (" IT", "Italy"),
    ("Cyprus", "Cyprus"), (" CY", "Cyprus"), (" GR", "Greece"), (" NL", "Netherlands"),
    ("Norway", "Norway"), ("Poland", "Poland"), ("Puerto Rico", "Puerto Rico"),
    ("Australia", "Australia"),
]
