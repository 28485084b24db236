"""Results depend on them, so they are stated as they are."""

# Fixed value: chain id of the test network that the jobs leave out.
TEST_CHAIN_ID = 11155111

# Chain id and lower-case chain name.
CHAIN_SLUGS = [
    (1, "ethereum"),
    (10, "optimism"),
    (137, "polygon"),
    (250, "fantom"),
    (324, "zksync"),
    (424, "pgn"),
    (8453, "base"),
    (42161, "arbitrum"),
    (43114, "avalanche"),
    (534352, "scroll"),
    (1329, "sei"),
    (11155111, "sepolia"),
    (42220, "celo"),
    (56, "binance"),
    (100, "gnosis"),
    (1284, "moonbeam"),
    (1285, "moonriver"),
    (25, "cronos"),
    (128, "huobi"),
    (1666600000, "harmony"),
    (2222, "kava"),
    (30, "rsk"),
    (288, "boba network"),
    (1313161554, "aurora"),
    (42262, "oasis emerald"),
    (1088, "metis andromeda"),
    (66, "okexchain"),
    (1101, "polygon zkevm"),
    (592, "astar"),
    (42, "lukso"),
]

# Chain id and display name used by the round totals report.
CHAIN_TITLES = [
    (1, "Ethereum"),
    (10, "Optimism"),
    (137, "Polygon"),
    (250, "Fantom"),
    (324, "zkSync"),
    (424, "PGN"),
    (8453, "Base"),
    (42161, "Arbitrum One"),
    (43114, "Avalanche"),
    (534352, "Scroll"),
    (1329, "SEI"),
    (11155111, "Sepolia"),
]

# Strategy names as the source tables spell them.
QF_V1 = "allov1.QF"
DIRECT_V1 = "allov1.Direct"
VOTING_V2 = "allov2.DonationVotingMerkleDistributionDirectTransferStrategy"
DIRECT_LITE_V2 = "allov2.DirectGrantsLiteStrategy"
DIRECT_ALLOCATION_V2 = "allov2.DirectAllocationStrategy"
MACI_V2 = "allov2.MACIQF"
MACI_LABEL = "MACIQF"
EXTERNAL_VOTING = "DonationVotingMerkleDistributionDirectTransferStrategy"

# Strategy name and its title in the round totals report.
STRATEGY_TITLES = {
    QF_V1: "Allo QF",
    VOTING_V2: "Allo QF",
    DIRECT_V1: "Direct Grants",
    DIRECT_LITE_V2: "Direct Grants",
    DIRECT_ALLOCATION_V2: "Direct Donations",
}
MACI_TITLE = "MACI QF"
DIRECT_ALLOCATION_ROUND_NAME = "Direct Donations Round"

# Contract developer addresses that share in the value moved.
DEV_V2 = "0x8c180840fcbb90ce8464b4ecd12ab0f840c6647c"
DEV_V1_OPTIMISM = "0xb8cef765721a6da910f14be93e7684e9a3714123"
DEV_DEFAULT = "0x1fd06f088c720ba3b7a3634a8f021fdd485dca42"
DEV_VOTING = "0x79427367e9be16353336d230de3031d489b1b3c3"
DEV_MACI = "0xc72492618dff005ef57688281b5c78fbc5912287"

# The one round whose pool percentages are stored 10^12 too large.
RESCALED_ROUND_ID = "0xa1d52f9b5339792651861329a046dd912761e9a9"
RESCALE_DIVISOR = 1_000_000_000_000

# Voice credits to USD is credits / 100000 * 3000.
CREDITS_PER_UNIT = 100_000
USD_PER_UNIT = 3_000

# Rounds left out of the program list of the round totals report.
EXCLUDED_PROGRAM_ROUNDS = [
    "0x911ae126be7d88155aa9254c91a49f4d85b83688",
    "0x40511f88b87b69496a3471cdbe1d3d25ac68e408",
    "0xc08008d47e3deb10b27fc1a75a96d97d11d58cf8",
    "0xb5c0939a9bb0c404b028d402493b86d9998af55e",
]

# First day of the round totals report; least GMV of an event.
REPORT_START = "2024-01-01 00:00:00"
MIN_GMV = 0.5

# Checkout type and chain id of historical contributions.
CHECKOUT_CHAINS = {"eth_std": 1, "eth_polygon": 137, "eth_zksync": 324}

# Labels written into the historical tables.
ALPHA_ROUND_NUM = 16
ALPHA_SOURCE = "Alpha"
ALPHA_PAYOUT_DATE = "2023-04-01 00:00:00"
CONTRIBUTION_SOURCE = "CGrants"
CONTRIBUTION_ROUND_PREFIX = "Gitcoin Grants "
CONTRIBUTION_ROUND_ID_BASE = 100_000
INDEXED_DONATION_SOURCE = "GrantsStack"
UNKNOWN_PROJECT = "unknown"

# Where an attributed event comes from.
FROM_DONATION = "donation"
FROM_DISTRIBUTION = "distribution"
FROM_MACI = "maci_contribution"
FROM_EXTERNAL = "dune"

# Profile source labels and the attributes that link profiles.
HISTORICAL_PROFILE_SOURCE = "cGrants"
INDEXED_PROFILE_SOURCE = "indexer"
PROFILE_ATTRIBUTES = ["title", "website", "payout_address", "project_twitter", "project_github"]
MIN_SHARED_ATTRIBUTES = 3

# Patterns.
ADDRESS_PATTERN = "^0x[a-fA-F0-9]{40}$"
MONEY_SYMBOLS = "[$,]"
# Unicode white space, spelled out so that every regex engine reads it alike.
WHITE_SPACE = r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
PUNCTUATION_PATTERN = r"[^\p{L}\p{N}_" + WHITE_SPACE + "]"
WHITE_SPACE_PATTERN = "[" + WHITE_SPACE + "]+"
REPO_HOST_PREFIXES = ["https://github.com/", "http://github.com/"]

# Names of the flattened score table and the columns it drops.
SCORE_RENAMES = {"key_0": "model", "key_1": "address"}
SCORE_DROPS = [
    "data_meta_version",
    "data_meta_training_date",
    "data_gas_spent",
    "data_n_days_active",
    "data_n_transactions",
    "data_has_safe_nft",
]
