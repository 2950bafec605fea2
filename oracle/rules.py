"""Segment rules of the reports, written out for the oracle (not imported from the code under test).

Fixed values, in the order in which they are tried; the first that holds
gives the result.  A list means any of its values, None means NULL, and a
result that begins with "=" copies the field named after it.
"""

SUB_REGION = {
  "A": [
    ({"role": "NBA"}, "NBA"),
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"]}, "Services, Software & Content"),
    ({"region": "UK", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"region": "UK", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"country": "United States", "industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services"]}, "Services"),
    ({"country": "United States", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"country": "United States", "industry": None}, "No industry"),
    ({"country": "Canada"}, "CA"),
    ({"region": "Southern EU"}, "=country"),
    ({"region": "Northern EU", "country": ["Germany", "Austria", "Switzerland"]}, "DACH"),
    ({"region": "Northern EU", "country": ["Belgium", "Netherlands", "Luxembourg"]}, "BENELUX"),
    ({"region": "Northern EU", "country": ["Norway", "Finland", "Sweden", "Denmark", "Iceland"]}, "NORDICS"),
    ({"region": "AU/NZ"}, "=country"),
    ({"region": "SG/HK"}, "=industry"),
    ({"region": "New Markets"}, "=country"),
    ({"region": "IE"}, "=country"),
  ],
  "B": [
    ({"role": "NBA"}, "NBA"),
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"]}, "Services, Software & Content"),
    ({"region": "UK", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"region": "UK", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"country": "United States", "industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services"]}, "Services"),
    ({"country": "United States", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"country": "United States", "industry": None}, "No industry"),
    ({"country": "Canada"}, "Canada"),
    ({"region": "Southern EU"}, "=country"),
    ({"region": "Northern EU", "country": ["Germany", "Austria", "Switzerland"]}, "DACH"),
    ({"region": "Northern EU", "country": ["Belgium", "Netherlands", "Luxembourg"]}, "BENELUX"),
    ({"region": "Northern EU", "country": ["Norway", "Finland", "Sweden", "Denmark", "Iceland"]}, "NORDICS"),
    ({"region": "AU"}, "=country"),
    ({"region": "SG"}, "=country"),
    ({"region": "New Markets"}, "=country"),
    ({"region": "IE"}, "=country"),
  ],
  "C": [
    ({"role": "NBA"}, "NBA"),
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"]}, "Services, Software & Content"),
    ({"region": "UK", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"region": "UK", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"country": "United States", "industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services"]}, "Services"),
    ({"country": "United States", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"country": "United States", "industry": None}, "No industry"),
    ({"country": "Canada"}, "CA"),
    ({"region": "Southern EU"}, "=country"),
    ({"region": "Northern EU", "country": ["DE", "AT", "CH"]}, "DACH"),
    ({"region": "Northern EU", "country": ["BE", "NL", "LU"]}, "BENELUX"),
    ({"region": "Northern EU", "country": ["NO", "FI", "SE", "DK", "IS"]}, "NORDICS"),
    ({"region": "AU/NZ"}, "=country"),
    ({"region": "SG/HK"}, "=country"),
    ({"region": "New Markets"}, "=country"),
    ({"region": "IE"}, "=country"),
  ],
  "D": [
    ({"role": "NBA"}, "NBA"),
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"]}, "Services, Software & Content"),
    ({"region": "UK", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"region": "UK", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"country": "United States", "industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services"]}, "Services"),
    ({"country": "United States", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "United States", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"country": "United States", "industry": None}, "No industry"),
    ({"country": "Canada"}, "CA"),
    ({"region": "Southern EU"}, "=country"),
    ({"region": "Northern EU", "code": ["DE", "AT", "CH"]}, "DACH"),
    ({"region": "Northern EU", "code": ["BE", "NL", "LU"]}, "BENELUX"),
    ({"region": "Northern EU", "code": ["NO", "FI", "SE", "DK", "IS"]}, "NORDICS"),
    ({"region": "AU/NZ"}, "=country"),
    ({"region": "SG/HK"}, "=industry"),
    ({"region": "New Markets"}, "=country"),
    ({"region": "IE"}, "=country"),
  ],
  "E": [
    ({"role": "NBA"}, "NBA"),
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate"]}, "Services, Software & Content"),
    ({"country": "US", "industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"country": "US", "industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate"]}, "Services"),
    ({"country": "US", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"country": "US", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"country": "US", "industry": None}, "No industry"),
    ({"country": "CA"}, "CA"),
    ({"region": "SouthernEU"}, "=country"),
    ({"region": "NorthernEU", "country": ["DE", "AT", "CH"]}, "DACH"),
    ({"region": "NorthernEU", "country": ["BE", "NL", "LU"]}, "BENELUX"),
    ({"region": "NorthernEU", "country": ["NO", "FI", "SE", "DK", "IS"]}, "BENELUX"),
    ({"region": "AU"}, "=country"),
    ({"region": "SG"}, "=country"),
    ({"region": "New Markets"}, "=country"),
    ({"region": "IE"}, "=country"),
  ],
}
SUB_REGION_ELSE = "other"

VERTICAL = {
  "A": [
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate", "On-Demand Services"]}, "Services, Software & Content"),
    ({"region": "UK", "industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"region": "UK", "industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate", "On-Demand Services"]}, "Services"),
    ({"industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"industry": None}, "No industry"),
  ],
  "E": [
    ({"region": "UK", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"region": "UK", "industry": ["Financial"]}, "Financial Services"),
    ({"region": "UK", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)", "Real Estate"]}, "Services, Software & Content"),
    ({"industry": ["B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Software & Content"),
    ({"industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate"]}, "Services"),
    ({"industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other Public Sector"]}, "Public Sector"),
    ({"industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"industry": None}, "No industry"),
  ],
  "F": [
    ({"country": "United Kingdom", "industry": ["Ticketing & Events", "Travel & Hosp"]}, "Ticketing/Travel"),
    ({"country": "United Kingdom", "industry": ["Financial"]}, "Financial Services"),
    ({"country": "United Kingdom", "industry": ["Healthcare", "Professional Services", "Other Services", "B2B", "B2C Software", "Content", "Other Software & Content", "B2C (Software)", "B2B (Software)"]}, "Services, Software & Content"),
    ({"industry": ["Ticketing & Events", "Financial", "Healthcare", "Professional Services", "Other Services", "Travel & Hosp", "Real Estate"]}, "Services"),
    ({"industry": ["Fashion", "Food & Bev", "Manufacturing", "Other Retail"]}, "Retail"),
    ({"industry": ["B2B", "B2C Software", "Content", "Other Software & Content"]}, "Software & Content"),
    ({"industry": ["Government", "EDU", "Non-Profit", "Utilities", "Other"]}, "Public Sector"),
    ({"industry": None}, "No industry"),
  ],
}
VERTICAL_ELSE = {"A": "other", "E": "other", "F": "Other"}
