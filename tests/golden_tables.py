"""The known frequent itemsets of 6148 baskets at support 0.05, and the known rules among
them above confidence 0.7, both in the order of the known tables."""

BASKETS = 6148

# item keys
INS = "POL_iNFTspaceToken (INS)_0xb988bd378a0754957d5d9471c96e0f8051645a26"
HEX = "ETH_HEX (HEX)_0x2b591e99afe9f32eaa6214f7b7629768c40eeb39"
LPT = "ETH_Livepeer Token (LPT)_0x58b6a8a3302369daec383334672404ee733ab239"
XDATA = "ETH_Streamr (old) (XDATA)_0x0cf0ee63788a0849fe5297f3407f701e122cc023"
OMG = "ETH_OMG Network (OMG)_0xd26114cd6ee289accf82350c8d8487fedb8a0c07"
USDT = "ETH_Tether USD (USDT)_0xdac17f958d2ee523a2206206994597c13d831ec7"
USDC = "ETH_USDC (USDC)_0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48"
WGC = "BASE_Wild Goat Coin (WGC)_0xfb18511f1590a494360069f3640c27d55c2b5290"
BNB = "BSC_BNB Chain (BNB)"
ACH = "BSC_Alchemy (ACH)_0xbc7d6b50616989655afd682fb42743507003056d"
POL = "POL_Polygon (POL)"
ETH = "ZKSYNC_Ether (ETH)"
MTV = "ETH_MultiVAC (MTV)_0x6226e00bcac68b0fe55583b90a1d727c14fab77f"
LINK = "ETH_ChainLink Token (LINK)_0x514910771af9ca656af840dff83e8264ecf986ca"
ETH_ACH = "ETH_Alchemy (ACH)_0xed04915c23f00a313a544955524eb7dbd823143d"
UNI = "ETH_Uniswap (UNI)_0x1f9840a85d5af5bf1d1762f925bdaddc4201f984"

# items, number of baskets
ITEMSETS = [
    ([INS], 3095),
    ([HEX], 2374),
    ([LPT], 2314),
    ([HEX, LPT], 1869),
    ([HEX, INS], 1771),
    ([XDATA], 1746),
    ([LPT, XDATA], 1677),
    ([LPT, INS], 1605),
    ([HEX, XDATA], 1521),
    ([OMG], 1490),
    ([HEX, LPT, XDATA], 1472),
    ([HEX, LPT, INS], 1436),
    ([LPT, OMG], 1391),
    ([OMG, XDATA], 1356),
    ([LPT, OMG, XDATA], 1326),
    ([HEX, OMG], 1246),
    ([HEX, LPT, OMG], 1217),
    ([HEX, OMG, XDATA], 1208),
    ([XDATA, INS], 1202),
    ([HEX, LPT, OMG, XDATA], 1188),
    ([LPT, XDATA, INS], 1169),
    ([HEX, XDATA, INS], 1107),
    ([HEX, LPT, XDATA, INS], 1087),
    ([USDT], 1055),
    ([OMG, INS], 965),
    ([LPT, OMG, INS], 926),
    ([OMG, XDATA, INS], 902),
    ([LPT, OMG, XDATA, INS], 892),
    ([HEX, OMG, INS], 877),
    ([HEX, LPT, OMG, INS], 864),
    ([HEX, OMG, XDATA, INS], 844),
    ([HEX, LPT, OMG, XDATA, INS], 839),
    ([USDC], 808),
    ([WGC], 529),
    ([WGC, USDC], 457),
    ([BNB], 425),
    ([ACH], 421),
    ([POL], 413),
    ([USDT, USDC], 409),
    ([ETH], 402),
    ([MTV], 398),
    ([LINK], 365),
    ([ACH, INS], 351),
    ([ETH_ACH], 344),
    ([ACH, ETH_ACH], 326),
    ([UNI], 310),
]

# antecedent, consequent, confidence, lift, support
RULES = [
    ([HEX, OMG, XDATA, INS], [LPT], 0.9940758293838863, 2.6411314602645346, 0.13646714378659727),
    ([OMG, XDATA, INS], [LPT], 0.9889135254988913, 2.6274158836504684, 0.14508783344176968),
    ([HEX, OMG, INS], [LPT], 0.9851767388825542, 2.617487722839215, 0.1405335068314899),
    ([HEX, OMG, XDATA], [LPT], 0.9834437086092715, 2.612883284585048, 0.19323357189329862),
    ([HEX, XDATA, INS], [LPT], 0.98193315266486, 2.608869931972152, 0.17680546519193233),
    ([OMG, XDATA], [LPT], 0.9778761061946902, 2.5980908819727553, 0.21567989590110606),
    ([HEX, OMG], [LPT], 0.9767255216693419, 2.5950339270627114, 0.1979505530253741),
    ([HEX, LPT, OMG], [XDATA], 0.9761709120788825, 3.437284517446145, 0.19323357189329862),
    ([XDATA, INS], [LPT], 0.9725457570715474, 2.58392883080202, 0.19014313597918023),
    ([HEX, LPT, OMG, INS], [XDATA], 0.9710648148148148, 3.4193049722116156, 0.13646714378659727),
    ([HEX, OMG], [XDATA], 0.9695024077046549, 3.413803437897032, 0.19648666232921275),
    ([HEX, XDATA], [LPT], 0.967784352399737, 2.571278391769051, 0.23942745608327912),
    ([LPT, OMG, INS], [XDATA], 0.9632829373650108, 3.391903493081378, 0.14508783344176968),
    ([HEX, OMG, INS], [XDATA], 0.9623717217787914, 3.3886949286918724, 0.1372804163955758),
    ([XDATA], [LPT], 0.9604810996563574, 2.5518745897525004, 0.27277163305139884),
    ([OMG, INS], [LPT], 0.9595854922279793, 2.5494950761528163, 0.15061808718282368),
    ([HEX, OMG, INS], [LPT, XDATA], 0.9566704675028507, 3.5072212487820664, 0.13646714378659727),
    ([HEX, OMG], [LPT, XDATA], 0.9534510433386838, 3.4954186132654907, 0.19323357189329862),
    ([LPT, OMG], [XDATA], 0.9532710280373832, 3.356649645116742, 0.21567989590110606),
    ([ETH_ACH], [ACH], 0.9476744186046512, 13.83919792299619, 0.05302537410540013),
    ([LPT, OMG, XDATA, INS], [HEX], 0.9405829596412556, 2.435848372314423, 0.13646714378659727),
    ([OMG, XDATA, INS], [HEX], 0.9356984478935698, 2.4231988448397925, 0.1372804163955758),
    ([OMG, INS], [XDATA], 0.9347150259067357, 3.2913104119556764, 0.14671437865972675),
    ([OMG], [LPT], 0.9335570469798657, 2.480340849106402, 0.22625243981782694),
    ([LPT, OMG, INS], [HEX], 0.9330453563714903, 2.4163280753883414, 0.1405335068314899),
    ([OMG, XDATA, INS], [HEX, LPT], 0.9301552106430155, 3.059707990922022, 0.13646714378659727),
    ([LPT, XDATA, INS], [HEX], 0.9298545765611634, 2.4080648427540154, 0.17680546519193233),
    ([OMG, INS], [LPT, XDATA], 0.9243523316062177, 3.388740688559944, 0.14508783344176968),
    ([XDATA, INS], [HEX], 0.9209650582362728, 2.38504346168349, 0.18005855562784645),
    ([OMG], [XDATA], 0.9100671140939597, 3.2045203994557068, 0.22055953155497723),
    ([OMG, INS], [HEX], 0.9088082901554404, 2.353560812079043, 0.1426480156148341),
    ([LPT, OMG, INS], [HEX, XDATA], 0.906047516198704, 3.6623143521299357, 0.13646714378659727),
    ([XDATA, INS], [HEX, LPT], 0.9043261231281198, 2.974744250931878, 0.17680546519193233),
    ([LPT, OMG, XDATA], [HEX], 0.8959276018099548, 2.3202034102475158, 0.19323357189329862),
    ([OMG, INS], [HEX, LPT], 0.8953367875647669, 2.945174194728832, 0.1405335068314899),
    ([LPT, INS], [HEX], 0.8947040498442368, 2.3170347508181837, 0.2335718932986337),
    ([OMG, XDATA], [HEX], 0.8908554572271387, 2.307067965894039, 0.19648666232921275),
    ([OMG], [LPT, XDATA], 0.8899328859060402, 3.2625565787420006, 0.21567989590110606),
    ([LPT, XDATA], [HEX], 0.877757901013715, 2.2731489365763773, 0.23942745608327912),
    ([OMG, XDATA], [HEX, LPT], 0.8761061946902655, 2.8819159363059135, 0.19323357189329862),
    ([LPT, OMG], [HEX], 0.8749101365923796, 2.2657740184372157, 0.1979505530253741),
    ([OMG, INS], [HEX, XDATA], 0.8746113989637305, 3.53524712743525, 0.1372804163955758),
    ([XDATA], [HEX], 0.8711340206185567, 2.2559949278697924, 0.2473975276512687),
    ([OMG, INS], [HEX, LPT, XDATA], 0.8694300518134715, 3.631288015318766, 0.13646714378659727),
    ([WGC], [USDC], 0.8638941398865785, 6.573293529731046, 0.0743331164606376),
    ([LPT, OMG], [HEX, XDATA], 0.8540618260244428, 3.4521841593677016, 0.19323357189329862),
    ([XDATA], [HEX, LPT], 0.843069873997709, 2.7732442939207678, 0.23942745608327912),
    ([OMG], [HEX], 0.836241610738255, 2.165633286781294, 0.20266753415744956),
    ([ACH], [INS], 0.833729216152019, 1.6561444978683726, 0.057091737150292775),
    ([OMG], [HEX, LPT], 0.8167785234899329, 2.686759958489089, 0.1979505530253741),
    ([HEX, INS], [LPT], 0.810841332580463, 2.1543009994402276, 0.2335718932986337),
    ([OMG], [HEX, XDATA], 0.810738255033557, 3.2770669243565473, 0.19648666232921275),
    ([LPT], [HEX], 0.8076923076923077, 2.0916985289352605, 0.30400130123617436),
    ([HEX, LPT, XDATA], [OMG], 0.8070652173913043, 3.330091917128684, 0.19323357189329862),
    ([OMG], [HEX, LPT, XDATA], 0.7973154362416107, 3.330091917128684, 0.19323357189329862),
    ([HEX, XDATA], [OMG], 0.7942143326758712, 3.277066924356548, 0.19648666232921275),
    ([LPT, XDATA], [OMG], 0.7906976744186046, 3.262556578742001, 0.21567989590110606),
    ([HEX, LPT], [XDATA], 0.7875869448903157, 2.7732442939207678, 0.23942745608327912),
    ([HEX], [LPT], 0.7872788542544229, 2.09169852893526, 0.30400130123617436),
    ([HEX, XDATA], [LPT, OMG], 0.7810650887573964, 3.4521841593677016, 0.19323357189329862),
    ([XDATA], [OMG], 0.7766323024054983, 3.204520399455707, 0.22055953155497723),
    ([ACH], [ETH_ACH], 0.7743467933491687, 13.839197922996188, 0.05302537410540013),
    ([HEX, LPT, XDATA, INS], [OMG], 0.7718491260349586, 3.1847841791026346, 0.13646714378659727),
    ([HEX, LPT], [INS], 0.7683253076511504, 1.5262242298672932, 0.2335718932986337),
    ([LPT, XDATA, INS], [OMG], 0.7630453378956373, 3.1484582130083076, 0.14508783344176968),
    ([HEX, XDATA, INS], [OMG], 0.7624209575429087, 3.1458819107206732, 0.1372804163955758),
    ([XDATA], [LPT, OMG], 0.7594501718213058, 3.356649645116742, 0.21567989590110606),
    ([HEX, XDATA, INS], [LPT, OMG], 0.7579042457091237, 3.3498168962039485, 0.13646714378659727),
    ([HEX, LPT, INS], [XDATA], 0.7569637883008357, 2.6654143015312357, 0.17680546519193233),
    ([XDATA, INS], [OMG], 0.7504159733777038, 3.0963472512255863, 0.14671437865972675),
    ([HEX], [INS], 0.7459983150800337, 1.4818732281460572, 0.28806115810019517),
    ([XDATA, INS], [LPT, OMG], 0.7420965058236273, 3.2799491860558305, 0.14508783344176968),
    ([HEX, LPT, XDATA], [INS], 0.7384510869565217, 1.466881189857414, 0.17680546519193233),
    ([LPT, INS], [XDATA], 0.7283489096573209, 2.564655839961746, 0.19014313597918023),
    ([HEX, XDATA], [INS], 0.727810650887574, 1.4457447113592263, 0.18005855562784645),
    ([LPT], [XDATA], 0.7247191011235955, 2.5518745897525, 0.27277163305139884),
    ([LPT, XDATA, INS], [HEX, OMG], 0.7177074422583405, 3.541304458269886, 0.13646714378659727),
    ([HEX, XDATA], [LPT, INS], 0.7146614069690993, 2.737531669810606, 0.17680546519193233),
    ([HEX, LPT, OMG], [INS], 0.7099424815119145, 1.4102508485735867, 0.1405335068314899),
    ([LPT, XDATA], [HEX, OMG], 0.7084078711985689, 3.4954186132654907, 0.19323357189329862),
    ([HEX, LPT, OMG, XDATA], [INS], 0.7062289562289562, 1.4028741915656293, 0.13646714378659727),
    ([HEX, OMG], [INS], 0.7038523274478331, 1.398153185508652, 0.1426480156148341),
    ([XDATA, INS], [HEX, OMG], 0.7021630615640599, 3.464605539723789, 0.1372804163955758),
]
