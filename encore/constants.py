"""Fixed values that must equal the reference's for equal results.

They are stated plainly, in the reference's own order, and used by name
everywhere else.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (taken from the reference; do not edit)
# ---------------------------------------------------------------------------

# Prediction snapping: below this a score becomes 0; within it (strictly) of the
# nearest half a score becomes that half.
SNAP_THRESHOLD = 0.03

# Outlier rule: keep training rows with |label - last season's total| <= 2.
OUTLIER_MAX_JUMP = 2.0

# Distance caps on predictions (miles): beyond the far cap the prediction is 0,
# beyond the near cap it is at most 1; "no cap" is written as 10000.
FAR_CAP_MILES = 300.0
NEAR_CAP_MILES = 60.0
NO_CAP = 10000.0
NEAR_CAP_VALUE = 1.0

# Venues (name, latitude, longitude), in the reference's order.
VENUES = [
    ("dBerkley", 37.867005, -122.261542),
    ("dSF", 37.7763272, -122.421545),
    ("dPeninsula", 37.4320436, -122.1661352),
]

# Earth radius in statute miles used by the great-circle distance.
EARTH_RADIUS_MILES = 3963.34

# State code that counts as "in state".
HOME_STATE = "CA"

# Placeholder level for a missing categorical value (an explicit NA level).
NA_LEVEL = "__NA__"

# Hotspot default when the tag is missing or blank.
HOTSPOT_DEFAULT = "No"

# Fold assignment: number of folds and seed.
NUM_FOLDS = 10
FOLD_SEED = 551724

# Row-wise window lengths (seasons) for mean / variance features.
WINDOW_YEARS = (2, 3, 4, 5, 6, 8)

# Prediction adjustments: seasons that must show activity, seasons that must
# not vary; light / hard variants.
ACTIVE_SEASONS = 6
INVARIANT_SEASONS = 9
ACTIVE_SEASONS_LIGHT = 4
INVARIANT_SEASONS_HARD = 5

# Random search: accept threshold on the fold mean, first-fold abandon threshold.
ACCEPT_THRESHOLD = 0.0925
ABANDON_THRESHOLD = 0.109

# Repeated hold-out for the linear driver.
HOLDOUT_RATIO = 0.15
HOLDOUT_SEEDS = (234294, 340549, 879138, 188231, 646946, 160318, 853181, 551724, 398728, 323126)

# Random search token list (feature-filter regex fragments), draw lists.
SEARCH_TOKENS = (
    "199", "200", "2000|2001|2002|2003|2004", "2005|2006|2007|2008", "2009", "2010", "2011", "2012",
    "price.level", "add_no", "TELEMAN|JOHANN|ROSSINI", "HANDEL", "VIVALDI", "HAYDN", "BACH",
    "conc_missed", "add_price", "add_tickets", "add_tickets_seats", "multiple.subs", "is.us",
    "relationship", "outside", "City", "State", "Lat|Long",
    "2.years", "3.years", "4.years|5.years", "6.years|7.years|8.years",
    "donating", "package", "no.seats", "location", "total",
)
SEARCH_TREES = (500, 1000, 1500, 2000, 2500, 3000, 4000, 2000, 2500, 3000, 4000, 5000, 6000, 8000, 10000, 15000)
SEARCH_SHRINKAGE = (0.001, 0.001, 0.001, 0.001, 0.0005, 0.002, 0.005, 0.01)
SEARCH_BAGFRAC = (0.5, 0.5, 0.5, 0.66, 0.4, 0.6)
SEARCH_DEPTHS = (1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 5, 5, 6, 6, 7, 8, 9, 10)
SEARCH_DISTRIB = ("gaussian", "tdist", "laplace")
SEARCH_DF = (1, 2, 3, 4, 6, 10, 15, 50, 100, 500, 1000)
SEARCH_START_FILTER = "billing.city|section_2013_2014"
# The search driver overwrites the drawn filter with this fixed one before fitting.
SEARCH_FIXED_FILTER = ("199|200|2010|2011|price.level|add_no|TELEMAN|JOHANN|ROSSINI|conc_missed|add_price|"
                       "add_tickets|add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|"
                       "relationship|City|State|Lat|Long")
# Budget rule: (trees above, depth above, tokens below) triples that are redrawn.
SEARCH_BUDGET = ((5000, 5, 26), (6000, 3, 28), (8000, 2, 30))

# Feature filters of the model drivers (regexes over feature names).
FILTER_GBM = ("199|200|2010|2011|no.seats|6.years|8.years|add_no|add_donated|TELEMAN|JOHANN|ROSSINI|"
              "add_price|conc_missed|ever.bought.subs|num.bought.ticket|add_tickets|add_tickets_seats|"
              "section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|Lat|Long|geo|"
              "Peninsula|Berkley|State|hotspot|City")
FILTER_KNN = ("199|package|location|price.level|add_no|TELEMAN|JOHANN|ROSSINI|add_price|add_tickets|"
              "add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|"
              "City|State|Lat|Long|package|section|location")
FILTER_LINEAR = "199|200|seats|add_"
FILTER_SVR = ("199|200|2010|price.level|add_no|TELEMAN|JOHANN|ROSSINI|conc_missed|add_price|add_tickets|"
              "add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|"
              "City|State|Lat|Long|package|section|location")
FILTER_KERNEL_SVR = ("199|200|2010|price.level|add_no|TELEMAN|JOHANN|ROSSINI|conc_missed|add_price|add_tickets|"
                     "add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|"
                     "City|State|Lat|Long|package|section|location|geo|hotspot|Berkley|Peninsula")
FILTER_FOREST = ("199|200|2010|price.level|add_no|TELEMAN|JOHANN|ROSSINI|conc_missed|add_price|add_tickets|"
                 "add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|"
                 "City|State|Lat|Long")
FILTER_SVC = ("199|200|2010|price.level|add_no|TELEMAN|JOHANN|ROSSINI|conc_missed|add_price|add_tickets|"
              "add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|"
              "City|State|Lat|Long|package|section|location|geo|hotspot")
FILTER_READJUST = ("199|price.level|add_no|TELEMAN|JOHANN|ROSSINI|conc_missed|add_price|add_tickets|"
                   "add_tickets_seats|section_2013_2014|multiple.subs|billing.city|is.us|relationship|outside|"
                   "City|State|Lat|Long")

# Boosted-tree driver defaults.
GBM_DEFAULTS = dict(trees=3375, bagfrac=0.5, trainfrac=1.0, shrinkage=0.001, depth=8,
                    distrib="tdist", minobsinnode=5, df=8, numfolds=10, clean=True)
# Support-vector regression grid (cost x gamma).
SVR_GRID = dict(cost=(20, 35, 50), gamma=(0.025, 0.05, 0.075))
# Kernel regression and classification drivers (Bessel kernel).
KERNEL_SVR = dict(sigma=0.01, cost=200.0, epsilon=0.25, order=10, degree=1)
KERNEL_SVC = dict(sigma=0.001, cost=100.0, order=10, degree=1)
# Insensitivity of the radial regression: its library's default.
SVR_EPSILON = 0.1
# KNN neighbours.
KNN_K = 3
# Ensemble-of-trees driver: number of trees.
FOREST_TREES = 300
