"""A complete two-level product with its expected totals. Fixed values."""

# good, part, quantity
EDGES = """
PILGRIM BLUEPRINT COPY,ELECTRONIC ENGINEERING,8
PILGRIM BLUEPRINT COPY,AMARRIAN STARSHIP ENGINEERING,8
PILGRIM BLUEPRINT COPY,ACCELERANT DECRYPTOR,1
FUSION THRUSTER,TUNGSTEN CARBIDE,13
FUSION THRUSTER,PHENOLIC COMPOSITES,3
FUSION THRUSTER,FERROGEL,1
RADAR SENSOR CLUSTER,TUNGSTEN CARBIDE,22
RADAR SENSOR CLUSTER,NANOTRANSISTORS,1
RADAR SENSOR CLUSTER,HYPERSYNAPTIC FIBERS,2
NANOELECTRICAL MICROPROCESSOR,TUNGSTEN CARBIDE,17
NANOELECTRICAL MICROPROCESSOR,PHENOLIC COMPOSITES,6
NANOELECTRICAL MICROPROCESSOR,NANOTRANSISTORS,2
NANOELECTRICAL MICROPROCESSOR,TERAHERTZ METAMATERIALS,2
TUNGSTEN CARBIDE ARMOR PLATE,TUNGSTEN CARBIDE,44
TUNGSTEN CARBIDE ARMOR PLATE,SYLRAMIC FIBERS,11
ANTIMATTER REACTOR UNIT,TUNGSTEN CARBIDE,9
ANTIMATTER REACTOR UNIT,FERMIONIC CONDENSATES,2
TESSERACT CAPACITOR UNIT,TUNGSTEN CARBIDE,27
TESSERACT CAPACITOR UNIT,FULLERIDES,11
TESSERACT CAPACITOR UNIT,NANOTRANSISTORS,1
TESSERACT CAPACITOR UNIT,TERAHERTZ METAMATERIALS,2
LINEAR SHIELD EMITTER,TUNGSTEN CARBIDE,22
LINEAR SHIELD EMITTER,SYLRAMIC FIBERS,9
LINEAR SHIELD EMITTER,FERROGEL,1
ARBITRATOR,TRITANIUM,444444
ARBITRATOR,PYERITE,100000
ARBITRATOR,MEXALLON,41111
ARBITRATOR,ISOGEN,8889
ARBITRATOR,NOCXIUM,2222
ARBITRATOR,ZYDRINE,1112
ARBITRATOR,MEGACYTE,222
R.A.M.- STARSHIP TECH,TRITANIUM,5.56
R.A.M.- STARSHIP TECH,PYERITE,4.44
R.A.M.- STARSHIP TECH,MEXALLON,2.22
R.A.M.- STARSHIP TECH,ISOGEN,0.82
R.A.M.- STARSHIP TECH,NOCXIUM,0.36
PILGRIM,PILGRIM BLUEPRINT COPY,1.17
PILGRIM,FUSION THRUSTER,57
PILGRIM,RADAR SENSOR CLUSTER,495
PILGRIM,NANOELECTRICAL MICROPROCESSOR,1800
PILGRIM,TUNGSTEN CARBIDE ARMOR PLATE,3750
PILGRIM,ANTIMATTER REACTOR UNIT,30
PILGRIM,TESSERACT CAPACITOR UNIT,375
PILGRIM,LINEAR SHIELD EMITTER,300
PILGRIM,MORPHITE,150
PILGRIM,CONSTRUCTION BLOCKS,75
PILGRIM,R.A.M.- STARSHIP TECH,18
PILGRIM,ARBITRATOR,1
"""

EFFICIENCY = {
    "R.A.M.- STARSHIP TECH": 9, "ARBITRATOR": 10, "ANTIMATTER REACTOR UNIT": 10, "NANOELECTRICAL MICROPROCESSOR": 10,
    "TESSERACT CAPACITOR UNIT": 10, "TUNGSTEN CARBIDE ARMOR PLATE": 10, "LINEAR SHIELD EMITTER": 10,
    "FUSION THRUSTER": 10, "RADAR SENSOR CLUSTER": 10, "PILGRIM": 4,
}

# leaf part, total for one unit, total for nine
TOTALS = """
ACCELERANT DECRYPTOR,1.17,10.53
AMARRIAN STARSHIP ENGINEERING,9.36,84.24
CONSTRUCTION BLOCKS,71,636
ELECTRONIC ENGINEERING,9.36,84.24
FERMIONIC CONDENSATES,52,450
FERROGEL,337,3024
FULLERIDES,3425,30814
HYPERSYNAPTIC FIBERS,823,7395
ISOGEN,7854,70673
MEGACYTE,196,1763
MEXALLON,36294,326643
MORPHITE,142,1271
NANOTRANSISTORS,3808,34254
NOCXIUM,1966,17689
PHENOLIC COMPOSITES,9108,81935
PYERITE,88268,794406
SYLRAMIC FIBERS,36476,328229
TERAHERTZ METAMATERIALS,3612,32489
TRITANIUM,392085,3528756
TUNGSTEN CARBIDE,186108,1674602
ZYDRINE,981,8828
"""


def edges():
    return [(g, p, q) for g, p, q in (line.split(",") for line in EDGES.strip().splitlines())]


def totals():
    return {p: (one, nine) for p, one, nine in (line.split(",") for line in TOTALS.strip().splitlines())}
