"""Fixed values.

These must equal the analytics being rebuilt for results to match; they are
the operators' defaults and are stated here once, plainly, in the order the
pipelines use them.
"""

# Click window and keyword lists
LOOKBACK_DAYS = 30            # clicks with dt > job date - 30 days
CLICK_DIM = "app"             # dim_type kept
TOP_KEYWORDS = 50             # keywords kept per sku
WINDOW_SIZE = 3               # consecutive keywords per window
WINDOW_SEP = " "              # joiner inside a window
TERM_SEP = ","                # joiner of terms in a category's term string

# Sample pairs
NEGATIVES_PER_NAME = 5

# Score features
MIN_GROUP = 20
MAX_GROUP = 12000
FRACTILE_POINTS = (0.25, 0.5, 0.75)   # positions floor(n*p) of the descending order

# Similarity lists
TOP_NEIGHBOURS = 200
NEIGHBOUR_ITEM_SEP = ","      # "c:s,c:s"
NEIGHBOUR_SCORE_SEP = ":"

# K-means
LLOYD_TOL = 0.01              # stop when the mean centroid shift is below this
LIBRARY_K = 3000
LIBRARY_SEED = 1

# augmentation
BAND_EDGES = (0, 5, 20, 50, 100, 200)  # rank bands [0,5) [5,20) [20,50) [50,100) [100,200)
DRAWS_PER_CATEGORY = 500
TOP_TERMS = 200
